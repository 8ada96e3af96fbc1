"""Type inference for arguments without a knowledge-base entry (E2; AG6-AG11, JN1, TK1-TK3).

Idea (from the original): an unlinkable argument is typed by the linked entities that
occur with the same relations. Linked entities give a relation its weight (how often two of
its occurrences share a type); an argument scores each entity by summing 10^(4·weight) over
the relations both occur in; the top entities vote for types.

The original bounds the work by samples and caps (150 occurrences per relation, 1 000
arguments per relation). Here everything counts, and the work stays bounded by structure:

* AG7 weight - occurrences enter as a histogram over (relation, type set). Pairs inside a set
  are n(n-1)/2, pairs of two sets n·m where the sets share a type; which distinct sets share
  one is worked out once for all relations. No pair of occurrences is ever formed.
* AG8 entity set - a long table (rel, fbid, types), no row holds a relation's entities.
* AG9/TK1 scores - arguments with the same relation set score every entity alike, and entities
  with the same relation set are scored alike by every argument. Both sides are reduced to
  *signature classes* (an order-free hash of the relation set), and class is scored against class.
  Relations are taken by descending weight: once the weights left cannot lift a new class to
  the k-th place, only the classes met so far are scored further (``top_classes``).

The caps and the sample remain as explicit settings (``TyperSettings``); none is on by default.

Deviations (documented): arrival order and random shuffles are replaced by md5 order;
arguments per relation are made distinct before a cap (the original caps raw rows, then
dedups); unknown type strings are dropped instead of failing the job; the
``maxRelInfosReadPerArg`` option is honoured (it is a no-op in the original CLI).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factweave import constants as C
from factweave.functions import arg_string_ok, exp_weight, filter_types, md5_order, rel_string_ok
from factweave.operators.caps import cap_per_key, top_n_per_key
from factweave.session import cut_lineage


@dataclass(frozen=True)
class TyperSettings:
    role: str = "arg1"
    max_similar_entities: int = C.MAX_SIMILAR_ENTITIES
    max_predicted_types: int = C.MAX_PREDICTED_TYPES
    min_share_score: int = C.MIN_SHARE_SCORE
    min_rel_weight: float = C.MIN_REL_WEIGHT
    keep_rel_string: bool = False
    max_entities_write_per_rel: int = C.MAX_ENTITIES_WRITE_PER_REL  # size of the sample (AG6)
    sample_relations: bool = False             # weight and entity set from the sample instead of all occurrences
    max_rel_infos_read_per_arg: int | None = None
    max_args_per_rel_info: int | None = None

    def __post_init__(self):
        if self.role not in ("arg1", "arg2"):  # PF1
            raise ValueError("role must be either arg1 or arg2")


def type_key(types) -> F.Column:
    return F.array_join(F.col(types) if isinstance(types, str) else types, ",")


def known_type_sets(type_sets: DataFrame, type_dim: DataFrame) -> DataFrame:
    """Map each distinct filtered type set to its subset known to the type dictionary (JN4).

    Works on *distinct* sets (far fewer than rows); the dictionary join is planned by
    adaptive execution (broadcast when its measured size is small). Sets left empty are absent.
    """
    ex = type_sets.select("ftypes", F.explode("ftypes").alias("type"))
    kn = ex.join(type_dim.select("type").distinct(), "type", "left_semi")
    return kn.groupBy("ftypes").agg(F.array_sort(F.collect_set("type")).alias("types"))


def entity_occurrences(tuples: DataFrame, s: TyperSettings, type_dim: DataFrame,
                       stoplist: DataFrame | None = None, id_cols=("row_id",)) -> DataFrame:
    """PF2 + PF4 + JN4: (rel, fbid, types) for each linked tuple with a non-empty known type set.

    One row per tuple, duplicates kept; ``h`` is the md5 order used by the sample and covers
    every kept column plus the evidence ``id_cols``.
    """
    r = s.role
    ids = [c for c in id_cols if c in tuples.columns]
    x = tuples.filter(F.col(f"{r}_fbid").isNotNull()).select(
        "rel", F.col(f"{r}_fbid").alias("fbid"), F.array_sort(filter_types(f"{r}_types")).alias("ftypes"), *ids)
    if stoplist is not None:
        x = x.join(stoplist.select("fbid"), "fbid", "left_anti")
    x = x.filter(F.size("ftypes") > 0)
    known = known_type_sets(x.select("ftypes").distinct(), type_dim)
    x = x.join(known, "ftypes", "inner").drop("ftypes").withColumn("tkey", type_key("types"))
    return x.withColumn("h", md5_order("rel", "fbid", "tkey", *ids)).drop(*ids)


def relation_sample(ent: DataFrame, s: TyperSettings) -> DataFrame:
    """AG6: per relation the first ``max_entities_write_per_rel`` occurrences in md5 order.

    md5 order is a uniform random order, so the original's read cap (5 000) followed by a
    random 150 is the same as taking the first 150 directly.
    """
    return cap_per_key(ent, ["rel"], "h", s.max_entities_write_per_rel, tiebreak=["fbid", "tkey"])


def entity_counts(ent: DataFrame) -> DataFrame:
    """Occurrences per distinct (rel, fbid, type set): the one reduction that AG7 and AG8 start from."""
    return ent.groupBy("rel", "fbid", "tkey", "types").agg(F.count(F.lit(1)).alias("n"))


def overlapping_sets(sets: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct type sets (tkey, types) that share a type.

    A pair meets once: under the smallest type the two sets share.
    """
    ex = sets.select("tkey", "types", F.explode("types").alias("type"))
    a, b = (ex.select("type", F.col("tkey").alias(k), F.col("types").alias(f"{k}_types")) for k in ("a", "b"))
    first = F.array_min(F.array_intersect("a_types", "b_types"))
    return a.join(b, "type").filter((F.col("a") < F.col("b")) & (F.col("type") == first)).select("a", "b")


def relation_stats(ent: DataFrame) -> DataFrame:
    """AG7: per relation n_sample (occurrences), overlapping pairs, all pairs, weight (unrounded) and weight_2dp.

    ``ent``: occurrences (rel, fbid, tkey, types), or their counts with a column ``n``. Counts of pairs
    are decimals: they grow with the square of a relation's occurrences.
    """
    one = F.col("n") if "n" in ent.columns else F.lit(1)
    hist = ent.groupBy("rel", "tkey", "types").agg(F.sum(one).cast("decimal(18,0)").alias("n"))
    inside = hist.groupBy("rel").agg(F.sum("n").cast("long").alias("n_sample"),
                                     F.sum((F.col("n") * (F.col("n") - 1)).cast("decimal(38,0)")).alias("inside2"))
    pairs_of_sets = overlapping_sets(hist.select("tkey", "types").distinct())
    left = hist.select("rel", F.col("tkey").alias("a"), F.col("n").alias("na"))
    right = hist.select("rel", F.col("tkey").alias("b"), F.col("n").alias("nb"))
    across = left.join(pairs_of_sets, "a").join(right, ["rel", "b"]) \
        .groupBy("rel").agg(F.sum((F.col("na") * F.col("nb")).cast("decimal(38,0)")).alias("across"))
    zero = F.lit(0).cast("decimal(38,0)")
    g = inside.join(across, "rel", "left").select(
        "rel", "n_sample", F.expr("CAST(inside2 AS DECIMAL(38,0)) div 2").alias("inside"), F.coalesce("across", zero).alias("across"),
        F.expr("(CAST(n_sample AS DECIMAL(18,0)) * (n_sample - 1)) div 2").alias("pairs"))
    g = g.withColumn("shared", (F.col("inside") + F.col("across")).cast("decimal(38,0)"))
    return g.select(
        "rel", "n_sample", "shared", "pairs",
        F.when(F.col("pairs") == 0, F.lit(0.0)).otherwise(F.col("shared").cast("double") / F.col("pairs").cast("double")).alias("weight"),
        F.when(F.col("pairs") == 0, F.lit(0.0)).otherwise(
            F.expr("CAST(200 * shared + pairs AS DECIMAL(38,0)) div (2 * pairs)").cast("double") / 100.0).alias("weight_2dp"))


def relation_info(stats: DataFrame, rel_ent: DataFrame, s: TyperSettings) -> DataFrame:
    """AG8 + PF5: relations with 4 <= length <= 100, an occurrence and weight >= min_rel_weight
    (unrounded), with the size of their entity set; later steps use weight_2dp."""
    size = rel_ent.groupBy("rel").agg(F.count(F.lit(1)).alias("n_entities"))
    return stats.filter(rel_string_ok("rel") & (F.col("n_sample") > 0) & (F.col("weight") >= F.lit(s.min_rel_weight))) \
        .join(size, "rel")


def relation_args(tuples: DataFrame, rel_info: DataFrame, s: TyperSettings) -> DataFrame:
    """JN1 + PF3 + ST2: distinct (rel, arg) for relations with info; AG2 caps in md5 order where the settings ask for them."""
    a = tuples.select("rel", F.col(s.role).alias("arg")).filter(arg_string_ok("arg")).distinct()
    if s.max_args_per_rel_info is not None or s.max_rel_infos_read_per_arg is not None:
        a = a.join(rel_info.select("rel"), "rel", "left_semi")
    if s.max_args_per_rel_info is not None:
        a = cap_per_key(a.withColumn("h", md5_order("rel", "arg")), ["rel"], "h", s.max_args_per_rel_info, tiebreak=["arg"]).drop("h")
    if s.max_rel_infos_read_per_arg is not None:
        a = cap_per_key(a.withColumn("h", md5_order("arg", "rel")), ["arg"], "h", s.max_rel_infos_read_per_arg, tiebreak=["rel"]).drop("h")
    return a.join(rel_info.select("rel", "weight_2dp", "n_entities"), "rel", "inner")


def signature() -> F.Column:
    """Aggregate: an order-free hash of the set of ``rel`` of a group (one row per relation), 128 bits and the count."""
    return F.concat(F.hex(F.bit_xor(F.xxhash64("rel"))), F.lit(":"), F.hex(F.bit_xor(F.xxhash64(F.lit("rel"), "rel"))), F.lit(":"), F.count(F.lit(1)))


def micro_weight(w2) -> F.Column:
    """10^(4·w) in millionths, as a long: exact like the decimal, and cheap to add up."""
    return (exp_weight(w2) * 1_000_000).cast("long")


def from_micro(c) -> F.Column:
    return (F.col(c).cast("decimal(28,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(34,6)")


@dataclass
class Classes:
    """Arguments and entities by their relation sets.

    ``args``: (arg, cls); ``arg_rels``: (cls, rel, term, weight_2dp, n_entities), once per class; ``ents``: (fbid, tkey, types, ecls);
    ``ent_rels``: (ecls, rel); ``ent_classes``: (ecls, members, fbid, tkey), the least member of each.
    """
    args: DataFrame
    arg_rels: DataFrame
    ents: DataFrame
    ent_rels: DataFrame
    ent_classes: DataFrame


def signature_classes(arg_rel: DataFrame, rel_ent: DataFrame, materialize: bool = True) -> Classes:
    """Classes of arguments and entities; with ``materialize`` each table, which several steps read, is stored once."""
    cut = cut_lineage if materialize else lambda df: df
    args = cut(arg_rel.groupBy("arg").agg(signature().alias("cls")))
    of_class = args.groupBy("cls").agg(F.min("arg").alias("arg"))
    arg_rels = cut(arg_rel.join(of_class, "arg").select("cls", "rel", micro_weight("weight_2dp").alias("term"), "weight_2dp", "n_entities"))
    ents = cut(rel_ent.groupBy("fbid", "tkey").agg(signature().alias("ecls"), F.first("types").alias("types")))
    ent_classes = ents.groupBy("ecls").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("fbid", "tkey")).alias("m")) \
        .select("ecls", "members", "m.fbid", "m.tkey")
    ent_rels = cut(rel_ent.join(ent_classes, ["fbid", "tkey"]).select("ecls", "rel"))
    return Classes(args, arg_rels, ents, ent_rels, ent_classes)


def class_scores(c: Classes, rels: DataFrame | None = None) -> DataFrame:
    """AG9: score(class of arguments, class of entities) = sum over shared relations of 10^(4·weight_2dp), in millionths."""
    r = c.arg_rels if rels is None else rels
    # small tables make many rows here: both sides are dealt by class into a fixed number of parts, which small sizes do not
    # merge; whichever side is broadcast, the other's classes are added up where they are joined
    parts = int(r.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine, theirs = r.select("cls", "rel", "term").repartition(parts, "cls"), c.ent_rels.repartition(parts, "ecls")
    return mine.join(theirs, "rel").groupBy("cls", "ecls").agg(F.sum("term").alias("score"))


def top_classes(c: Classes, k: int, materialize: bool = True) -> DataFrame:
    """(cls, ecls, score, fbid, tkey): the entity classes that hold the k best entities of each class of arguments.

    By descending weight, a relation is *heavy* while it and those after it together reach the term of a
    relation with at least k entities: an entity met in no heavy relation scores less than k others. The heavy
    relations are scored first; a class goes on to the light ones only if it can still reach the k-th place.
    """
    order = [F.col("term").desc(), F.col("rel")]
    after = Window.partitionBy("cls").orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy("cls")
    sure = F.coalesce(F.max(F.when(F.col("n_entities") >= k, F.col("term"))).over(whole), F.lit(0))
    r = c.arg_rels.withColumn("heavy", F.sum("term").over(after) >= sure)
    light = r.filter(~F.col("heavy")).select("cls", "rel", "term")
    part = class_scores(c, r.filter("heavy"))
    part = cut_lineage(part) if materialize else part  # read for the k-th place and again for what goes on
    best = top_n_per_key(part, ["cls"], [F.col("score").desc(), F.col("ecls")], k)
    kth = best.groupBy("cls").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(0)).alias("kth"))
    reach = light.groupBy("cls").agg(F.sum("term").alias("reach")).join(kth, "cls")
    open_ = part.join(reach, "cls", "left")
    # classes of arguments without light relations are done; others keep what can still reach the k-th place
    open_ = open_.filter(F.col("reach").isNull() | (F.col("score") + F.col("reach") >= F.col("kth"))).select("cls", "ecls", "score")
    more = open_.join(light, "cls").join(c.ent_rels, ["ecls", "rel"]).groupBy("cls", "ecls").agg(F.sum("term").alias("score"))
    total = open_.unionByName(more).groupBy("cls", "ecls").agg(F.sum("score").alias("score"))
    return total.join(c.ent_classes.select("ecls", "fbid", "tkey"), "ecls")


def class_top_entities(c: Classes, s: TyperSettings) -> DataFrame:
    """TK1 per class of arguments: (cls, rank, fbid, tkey, types, score), by score desc, then fbid, types.

    The k best entities lie in the k best entity classes, ordered by score and least member: a class with a
    member among the k best has its least member there too.
    """
    k = s.max_similar_entities
    order = [F.col("score").desc(), F.col("fbid"), F.col("tkey")]
    best = top_n_per_key(top_classes(c, k), ["cls"], order, k).select("cls", "ecls", "score")
    members = top_n_per_key(c.ents, ["ecls"], [F.col("fbid"), F.col("tkey")], k, "place").drop("place")
    top = top_n_per_key(best.join(members, "ecls").drop("ecls"), ["cls"], order, k)
    return cut_lineage(top.withColumn("score", from_micro("score")))


def of_args(per_class: DataFrame, c: Classes) -> DataFrame:
    """Rows per class of arguments as rows per argument."""
    return c.args.join(per_class, "cls").drop("cls")


def class_totals(c: Classes) -> DataFrame:
    """AG9 total: sum of 10^(4·w) over every (relation, entity) of the argument."""
    return c.arg_rels.groupBy("cls").agg(F.sum(F.col("term").cast("decimal(18,0)") * F.col("n_entities")).alias("total_weight")) \
        .withColumn("total_weight", from_micro("total_weight"))


def type_shares(top: DataFrame, type_dim: DataFrame, s: TyperSettings, by: str = "cls") -> DataFrame:
    """AG10: number of top entities carrying each type; keep >= min_share_score."""
    t = top.select(by, F.explode("types").alias("type")).groupBy(by, "type") \
        .agg(F.count(F.lit(1)).alias("share")).filter(F.col("share") >= s.min_share_score)
    return t.join(type_dim.select("type", "enum"), "type", "inner")


def top_types(shares: DataFrame, s: TyperSettings, by: str = "cls") -> DataFrame:
    """TK2: top ``max_predicted_types`` per class of arguments by share desc, then type enum."""
    return top_n_per_key(shares, [by], [F.col("share").desc(), F.col("enum")], s.max_predicted_types)


def notable_relations(arg_rel: DataFrame, by: str = "arg") -> DataFrame:
    """TK3: per argument (or class) its 4 heaviest relations (deduplicated), weight desc, then rel."""
    t = top_n_per_key(arg_rel, [by], [F.col("weight_2dp").desc(), F.col("rel")], C.NOTABLE_RELS)
    return t.groupBy(by).agg(F.array_sort(F.collect_list(
        F.struct((-F.col("weight_2dp")).alias("nw"), "rel", "weight_2dp"))).alias("rels")) \
        .select(by, F.transform("rels", lambda r: F.struct(r["rel"].alias("rel"), r["weight_2dp"].alias("weight"))).alias("rels"))


def predictions(types: DataFrame, top: DataFrame, totals: DataFrame, notable: DataFrame | None = None, by: str = "cls") -> DataFrame:
    """AG11: one row per class of arguments with at least one predicted type."""
    t = types.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("share")).alias("ns"), "enum", "type", "share"))).alias("t"))
    t = t.select(by, F.transform("t", lambda x: F.struct(x["type"].alias("type"), x["enum"].alias("enum"),
                                                            x["share"].alias("share"))).alias("types"))
    f = top.filter(F.col("rank") <= C.TOP_FBIDS_IN_PREDICTION).groupBy(by) \
        .agg(F.array_sort(F.collect_list(F.struct("rank", "fbid"))).alias("f")) \
        .select(by, F.transform("f", lambda x: x["fbid"]).alias("top_fbids"))
    p = t.join(totals, by, "inner").join(f, by, "inner")
    if notable is not None:
        p = p.join(notable, by, "left")
    else:
        p = p.withColumn("rels", F.array().cast("array<struct<rel:string,weight:double>>"))
    return p


PHASE_ONE = ("stats", "rel_info", "rel_ent", "arg_rel")


@dataclass
class PhaseOne:
    """Normalised phase-one result: relation weights, infos and entities, and (argument, relation) pairs."""
    stats: DataFrame
    rel_info: DataFrame
    rel_ent: DataFrame
    arg_rel: DataFrame


def phase_one(tuples: DataFrame, s: TyperSettings, type_dim: DataFrame, stoplist: DataFrame | None = None,
              id_cols=("row_id",), materialize: bool = True, store_pairs: bool | None = None) -> PhaseOne:
    """Relation infos, their entities and (argument, relation) pairs.

    With ``materialize`` the reduced occurrences and the pairs are written to the session's checkpoint folder, so the
    tuples are read twice, whatever is asked of the result; without, nothing runs before the caller's own action.
    ``store_pairs`` (default: as ``materialize``) is False where the pairs are read once or not at all.
    """
    store_pairs = materialize if store_pairs is None else store_pairs
    ent = entity_occurrences(tuples, s, type_dim, stoplist, id_cols)
    counts = entity_counts(relation_sample(ent, s) if s.sample_relations else ent)
    counts = cut_lineage(counts) if materialize else counts
    stats = relation_stats(counts)
    info = relation_info(stats, counts, s)
    info = cut_lineage(info) if materialize else info
    rel_ent = counts.join(info.select("rel"), "rel", "left_semi").drop("n")
    arg_rel = relation_args(tuples, info, s)
    return PhaseOne(stats, info, rel_ent, cut_lineage(arg_rel) if store_pairs else arg_rel)


def settings_fingerprint(s: TyperSettings) -> str:
    """What a stored phase one depends on: the settings that phase one reads."""
    used = ("role", "min_rel_weight", "sample_relations", "max_entities_write_per_rel", "max_rel_infos_read_per_arg", "max_args_per_rel_info")
    return json.dumps({k: getattr(s, k) for k in used}, sort_keys=True)


def store_phase_one(p1: PhaseOne, s: TyperSettings, path: str) -> None:
    """SRC11: phase one as Parquet tables below ``path``, with the fingerprint of its settings written last.

    A folder without a fingerprint is unfinished: ``open_phase_one`` refuses it.
    """
    spark = p1.rel_info.sparkSession
    for name in PHASE_ONE:
        getattr(p1, name).write.mode("overwrite").parquet(f"{path}/{name}")
    spark.createDataFrame([(settings_fingerprint(s),)], "settings string").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")


def open_phase_one(spark: SparkSession, path: str, s: TyperSettings) -> PhaseOne:
    """A stored phase one; ValueError if it was made with other settings than ``s``."""
    made = spark.read.parquet(f"{path}/settings").first().settings
    if made != settings_fingerprint(s):
        raise ValueError(f"phase one in {path} was made with {made}, not {settings_fingerprint(s)}")
    return PhaseOne(*(spark.read.parquet(f"{path}/{name}") for name in PHASE_ONE))


def phase_two(p1: PhaseOne, s: TyperSettings, type_dim: DataFrame) -> DataFrame:
    """AG11 for every argument: computed per class of arguments, then handed to the arguments."""
    c = signature_classes(p1.arg_rel, p1.rel_ent)
    top = class_top_entities(c, s)
    tt = top_types(type_shares(top, type_dim, s), s)
    notable = notable_relations(c.arg_rels, "cls") if s.keep_rel_string else None
    return of_args(predictions(tt, top, class_totals(c), notable), c)


def predict_types(tuples: DataFrame, s: TyperSettings, type_dim: DataFrame, stoplist: DataFrame | None = None,
                  id_cols=("row_id",), stage: str = "full", stored: str | None = None):
    """Stage selection: 'full'; 'one' writes phase one below ``stored`` and returns it; 'two' opens it there
    (``tuples`` is not read) and returns the predictions."""
    if stage not in ("full", "one", "two"):
        raise ValueError("stage must be 'full', 'one' or 'two'")
    if stage == "two":
        if not stored:
            raise ValueError("stage 'two' needs the folder of a stored phase one")
        return phase_two(open_phase_one(type_dim.sparkSession, stored, s), s, type_dim)
    p1 = phase_one(tuples, s, type_dim, stoplist, id_cols)
    if stage == "one":
        if stored:
            store_phase_one(p1, s, stored)
        return p1
    return phase_two(p1, s, type_dim)


def flat_predictions(pred: DataFrame) -> DataFrame:
    """Report form: arg, 'type@share, ...', total weight (double), 'fbid,fbid'."""
    return pred.select(
        "arg",
        F.array_join(F.transform("types", lambda t: F.concat(t["type"], F.lit("@"), t["share"].cast("string"))), ", ").alias("types"),
        F.col("total_weight").cast("double").alias("total_weight"),
        F.array_join("top_fbids", ",").alias("top_fbids"))
