"""Registered queries: one per operator id of SURVEY §2, each with its DuckDB twin.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the whole driver tables (through the
fixture views). Columns are flat and aliased identically on both sides.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.operators import grouping as G
from factweave.operators.score import score
from factweave.plans import sql_twins as S
from factweave.session import cut_lineage, drop_stored, scratch_path
from factweave.sources import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared Spark-side inputs
# ---------------------------------------------------------------------------

def scored_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(FX.with_norms(FX.extractions(spark, sf_dir)))


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct instances of every group."""
    return G.group_instances(scored_extractions(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.summarize(scored_extractions(spark, sf_dir))


# ---------------------------------------------------------------------------
# E1 minimum slice: group + frequency filter
# ---------------------------------------------------------------------------

@register("ag1_group_extractions",
          S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + "SELECT * FROM grp")
def ag1_group_extractions(spark, sf_dir):
    return summary(spark, sf_dir)


@register("pf6_frequency_filter",
          S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + "SELECT * FROM grp WHERE n_instances BETWEEN 2 AND 2147483647")
def pf6_frequency_filter(spark, sf_dir):
    return G.frequency_filter(summary(spark, sf_dir), min_freq=2)


AG2_CAP = 2  # small cap so that it binds on the fixture (groups of 1-6 instances)


@register("ag2_group_cap", S.with_(S.EXTRACTIONS) + f"""
SELECT arg1, rel, arg2, count(DISTINCT inst_id) AS n_instances, min(inst_id) AS first_inst, max(inst_id) AS last_inst
FROM (SELECT *, row_number() OVER (PARTITION BY arg1, rel, arg2 ORDER BY inst_id) AS rn FROM ex_i)
WHERE rn <= {AG2_CAP}
GROUP BY arg1, rel, arg2""")
def ag2_group_cap(spark, sf_dir):
    # ids travel as 16 bytes, which are ordered as their hex form is
    x = scored_extractions(spark, sf_dir).withColumn("inst_id", F.unhex(G.instance_hash()))
    inst = G.group_instances(x, max_group_size=AG2_CAP, columns=[])
    first, last = (F.lower(F.hex(f("inst_id"))) for f in (F.min, F.max))
    return inst.groupBy(*G.KEY).agg(F.count(F.lit(1)).alias("n_instances"), first.alias("first_inst"), last.alias("last_inst"))


# ---------------------------------------------------------------------------
# E2 typing. Fixture setting: min_share_score = 3 (with the command-line value 10 no type
# reaches the share threshold on this fixture); every other setting is the CLI default.
# ---------------------------------------------------------------------------

from factweave.operators import typing as T  # noqa: E402

TYPING = T.TyperSettings(role="arg1", min_share_score=3)
TYPING_CTES = [S.EXTRACTIONS, S.TUPLES, *S.typing_ctes("arg1", k=TYPING.max_similar_entities,
                                                         max_types=TYPING.max_predicted_types,
                                                         min_share=TYPING.min_share_score,
                                                         min_w=TYPING.min_rel_weight)]
TYPING_SQL = S.with_(*TYPING_CTES)


def typing_inputs(spark, sf_dir):
    """Typing tuples and the type dictionary."""
    return FX.tuples(spark, sf_dir), FX.type_dim(spark, sf_dir)


@register("ag6_relation_sample", TYPING_SQL + "SELECT rel, fbid, tkey, h FROM samp")
def ag6_relation_sample(spark, sf_dir):
    tup, dim = typing_inputs(spark, sf_dir)
    return T.relation_sample(T.entity_occurrences(tup, TYPING, dim), TYPING).select("rel", "fbid", "tkey", "h")


@register("ag7_relation_weight", TYPING_SQL + "SELECT rel, n_sample, shared, weight, weight_2dp FROM stats2")
def ag7_relation_weight(spark, sf_dir):
    """The weight of every relation, from all its occurrences (``n_sample`` of them) as a histogram of type sets."""
    tup, dim = typing_inputs(spark, sf_dir)
    st = T.relation_stats(T.entity_occurrences(tup, TYPING, dim))
    return st.select("rel", "n_sample", F.col("shared").cast("long").alias("shared"), "weight", "weight_2dp")


def typing_tables(spark, sf_dir):
    """Phase one with its reduced occurrences and infos stored, which its parts read several times; the pairs, which one
    step reads, are not."""
    tup, dim = typing_inputs(spark, sf_dir)
    return T.phase_one(tup, TYPING, dim, store_pairs=False), dim


def typing_classes(spark, sf_dir):
    tup, dim = typing_inputs(spark, sf_dir)
    p1 = T.phase_one(tup, TYPING, dim)
    return T.signature_classes(p1.arg_rel, p1.rel_ent), dim


@register("ag8_relation_info", TYPING_SQL + """
SELECT r.rel, r.weight_2dp, r.n_entities, e.fbid, e.tkey FROM relinfo r JOIN rel_ent e ON r.rel = e.rel""")
def ag8_relation_info(spark, sf_dir):
    """Relation infos with their entity set, one row per entity."""
    p1, _ = typing_tables(spark, sf_dir)
    return p1.rel_info.join(p1.rel_ent, "rel").select("rel", "weight_2dp", "n_entities", "fbid", "tkey")


@register("jn1_rel_args", TYPING_SQL + "SELECT arg, rel, weight_2dp, n_entities FROM ar")
def jn1_rel_args(spark, sf_dir):
    return typing_tables(spark, sf_dir)[0].arg_rel.select("arg", "rel", "weight_2dp", "n_entities")


@register("ag9_entity_scores", TYPING_SQL + """
SELECT s.arg, s.n_entities, s.max_score, CAST(t.total_weight AS DOUBLE) AS total_weight
FROM (SELECT arg, count(*) AS n_entities, CAST(max(score) AS DOUBLE) AS max_score FROM scores GROUP BY arg) s
JOIN totals t ON s.arg = t.arg""")
def ag9_entity_scores(spark, sf_dir):
    """Per argument: how many entities it scores, the best score, and the total weight; scored class against class."""
    c, _ = typing_classes(spark, sf_dir)
    sc = T.class_scores(c).join(c.ent_classes.select("ecls", "members"), "ecls").groupBy("cls").agg(
        F.sum("members").alias("n_entities"), F.max("score").alias("max_score")) \
        .withColumn("max_score", T.from_micro("max_score").cast("double"))
    return T.of_args(sc.join(T.class_totals(c), "cls"), c).select(
        "arg", "n_entities", "max_score", F.col("total_weight").cast("double").alias("total_weight"))


@register("tk1_top_entities", TYPING_SQL + "SELECT arg, rank, fbid, tkey, CAST(score AS DOUBLE) AS score FROM top")
def tk1_top_entities(spark, sf_dir):
    c, _ = typing_classes(spark, sf_dir)
    return T.of_args(T.class_top_entities(c, TYPING), c).select(
        "arg", F.col("rank").cast("long").alias("rank"), "fbid", "tkey", F.col("score").cast("double").alias("score"))


@register("ag10_type_shares", TYPING_SQL + "SELECT arg, type, share, enum FROM shares")
def ag10_type_shares(spark, sf_dir):
    c, dim = typing_classes(spark, sf_dir)
    return T.of_args(T.type_shares(T.class_top_entities(c, TYPING), dim, TYPING), c).select("arg", "type", "share", "enum")


@register("tk2_top_types", TYPING_SQL + "SELECT arg, rank, type, share FROM ttypes")
def tk2_top_types(spark, sf_dir):
    c, dim = typing_classes(spark, sf_dir)
    tt = T.top_types(T.type_shares(T.class_top_entities(c, TYPING), dim, TYPING), TYPING)
    return T.of_args(tt, c).select("arg", F.col("rank").cast("long").alias("rank"), "type", "share")


@register("ag11_type_predictions", TYPING_SQL + "SELECT * FROM pred")
def ag11_type_predictions(spark, sf_dir):
    tup, dim = typing_inputs(spark, sf_dir)
    return T.flat_predictions(T.predict_types(tup, TYPING, dim))


NATIONS = """tuples AS (
  SELECT arg1, arg1_fbid, arg1_types, rel, replace(rel, 'supplied by ', '') AS arg2, arg2_fbid, arg2_types,
         CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS row_id FROM ex)"""


@register("pf1_typing_arg2", S.with_(S.EXTRACTIONS, NATIONS, *S.typing_ctes("arg2", min_share=1)) + "SELECT * FROM pred")
def pf1_typing_arg2(spark, sf_dir):
    """Typing of the second argument: the nation a relation names, typed by the suppliers linked there."""
    tup, dim = typing_inputs(spark, sf_dir)
    tup = tup.withColumn("arg2", F.replace("rel", F.lit("supplied by "), F.lit("")))
    return T.flat_predictions(T.predict_types(tup, T.TyperSettings(role="arg2", min_share_score=1), dim))


@register("tk3_notable_relations", TYPING_SQL + """
SELECT arg, string_agg(rel || ':' || printf('%.2f', weight_2dp), ', ' ORDER BY weight_2dp DESC, rel) AS rels
FROM (SELECT *, row_number() OVER (PARTITION BY arg ORDER BY weight_2dp DESC, rel) AS rn FROM ar)
WHERE rn <= 4 GROUP BY arg""")
def tk3_notable_relations(spark, sf_dir):
    nr = T.notable_relations(typing_tables(spark, sf_dir)[0].arg_rel)
    return nr.select("arg", F.array_join(F.transform("rels", lambda r: F.concat(
        r["rel"], F.lit(":"), F.format_string("%.2f", r["weight"]))), ", ").alias("rels"))


# ---------------------------------------------------------------------------
# linked groups and the aggregations over them
# ---------------------------------------------------------------------------

def scored_rows(spark, sf_dir):
    """Scored fixture extractions with their instance hash."""
    return scored_extractions(spark, sf_dir).withColumn("inst_id", G.instance_hash())


def linked(spark, sf_dir, parts=G.PARTS):
    return G.linked_groups(scored_rows(spark, sf_dir), parts)


LINKED_SQL = S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS, S.LINKED)


@register("ag5_inlink_ratio", LINKED_SQL + """
SELECT CASE WHEN inl = 0 THEN CAST('inf' AS DOUBLE)
            ELSE CAST(CAST(floor((20000 * n + inl) / (2 * inl)) AS BIGINT) AS DOUBLE) / CAST(10000.0 AS DOUBLE) END AS ratio,
       name, fbid, n AS n_groups, inl AS inlinks
FROM (SELECT arg1_fbid AS fbid, count(*) AS n,
             arg_min(arg1_name, arg1 || chr(9) || rel || chr(9) || arg2) AS name,
             CAST(arg_min(arg1_inlinks, arg1 || chr(9) || rel || chr(9) || arg2) AS BIGINT) AS inl
      FROM lg WHERE arg1_fbid IS NOT NULL GROUP BY arg1_fbid)""")
def ag5_inlink_ratio(spark, sf_dir):
    return G.inlink_ratio(linked(spark, sf_dir, [f"arg1_{c}" for c in ("fbid", "name", "inlinks")]), "arg1")


@register("ag4_arg_pairs", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + """
SELECT rel, arg1 || '+' || arg2 AS pair FROM grp""")
def ag4_arg_pairs(spark, sf_dir):
    return G.arg_pairs(summary(spark, sf_dir))


@register("pf11_answer_keys", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + """
SELECT coalesce(arg1, '') AS arg1, coalesce(rel, '') AS rel, coalesce(arg2, '') AS arg2, count(*) AS n_groups
FROM grp GROUP BY GROUPING SETS ((arg1, rel, arg2), (rel, arg2), (arg1, arg2), (arg1, rel), (arg1), (rel), (arg2))""")
def pf11_answer_keys(spark, sf_dir):
    return G.answer_keys(summary(spark, sf_dir), expand=True)


@register("pf10_render_groups", LINKED_SQL + f""",
first AS (
  SELECT arg1, rel, arg2,
         arg_min({{'tokens': tokens, 'arg1_start': arg1_start, 'arg1_len': arg1_len, 'rel_start': rel_start,
                  'rel_len': rel_len, 'arg2_start': arg2_start, 'arg2_len': arg2_len}}, inst_id) AS f,
         array_to_string(list_sort(list(DISTINCT array_to_string(tokens, ' '))), chr(9)) AS sentences
  FROM inst GROUP BY arg1, rel, arg2
)
SELECT l.arg1, l.rel, l.arg2, concat_ws(chr(9),
  {', '.join(f"array_to_string(list_slice(f.f.tokens, f.f.{p}_start + 1, f.f.{p}_start + f.f.{p}_len), ' ')" for p in ('arg1', 'rel', 'arg2'))},
  CASE WHEN l.arg1_fbid IS NULL THEN 'none' ELSE '(' || l.arg1_name || ',' || l.arg1_fbid || ')' END,
  CASE WHEN l.arg2_fbid IS NULL THEN 'none' ELSE '(' || l.arg2_name || ',' || l.arg2_fbid || ')' END,
  f.sentences) AS line
FROM lg l JOIN first f ON l.arg1 = f.arg1 AND l.rel = f.rel AND l.arg2 = f.arg2""")
def pf10_render_groups(spark, sf_dir):
    fields = ("fbid", "name")
    rows = scored_rows(spark, sf_dir).withColumn("inst_id", F.unhex("inst_id")).select(*G.KEY, *G.INSTANCE, "inst_id", *[f"{r}_{c}" for r in ("arg1", "arg2") for c in fields])
    rows = cut_lineage(rows.drop("url", "corpus", "confidence"))  # read for the instances and for the parts
    parts = cut_lineage(G.first_instance_parts(rows, G.KEY, fields))
    inst = cut_lineage(G.group_instances(rows, columns=["tokens", *G.SPANS]))
    drop_stored(rows)
    return G.render_groups(inst, parts)


def batch_rows(spark, sf_dir, fields: tuple[str, ...] = ("fbid", "name", "inlinks", "types")):
    """Scored rows in three batches (by the md5 of the url: 0, 3 and 12), ids as their 16 bytes. ``fields``: the parts that the query reads."""
    digit = F.substring(F.md5("url"), 1, 1)
    rows = scored_rows(spark, sf_dir).withColumn("batch", F.when(digit < "5", F.lit(0)).when(digit < "a", F.lit(3)).otherwise(F.lit(12)))
    parts = [f"{r}_{c}" for r in ("arg1", "arg2") for c in fields]
    return rows.select("l_orderkey", "batch", F.unhex(G.row_hash("batch", *G.KEY)).alias("gid"), *G.KEY, *G.INSTANCE, F.unhex("inst_id").alias("inst_id"), *parts)


def batches(rows, fields: tuple[str, ...] = ("fbid", "name", "inlinks", "types"), columns=(*G.KEY, *G.INSTANCE)):
    """(instances, parts) of the groups of every batch; batch 12 arrives unscored. ``columns``: of the instances, what the query reads."""
    unscored = rows.withColumn("confidence", F.when(F.col("batch") == 12, F.lit(None).cast("double")).otherwise(F.col("confidence")))
    inst = G.one_per(unscored, ["gid", "batch", "inst_id"], list(columns))
    return inst, G.first_instance_parts(rows, ["gid", "batch"], fields)


def batched(spark, sf_dir, fields: tuple[str, ...] = ("fbid", "name", "inlinks", "types")):
    """Three batches of groups, as (instances, parts)."""
    return batches(batch_rows(spark, sf_dir, fields), fields)


def stored_batches(spark, sf_dir, *evidence: str):
    """The same for a regroup, which forms the keys anew: without them, with the parts' fbids alone and the ``evidence`` asked for,
    from stored rows, which both read, and with the parts stored too. The rows can go once the instances have been read."""
    rows = cut_lineage(batch_rows(spark, sf_dir, ("fbid",)))
    inst, parts = batches(rows, ("fbid",), (*evidence, *G.INSTANCE))
    return inst, cut_lineage(parts), rows


@register("ag3_regroup", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS, S.BATCHED) + """
SELECT g.arg1, g.rel, g.arg2, g.n_instances, g.max_conf,
       struct_extract(h.e, 'arg1_fbid') AS arg1_fbid, struct_extract(h.e, 'arg2_fbid') AS arg2_fbid
FROM grp g JOIN head h ON g.arg1 = h.arg1 AND g.rel = h.rel AND g.arg2 = h.arg2""")
def ag3_regroup(spark, sf_dir):
    inst, parts, rows = stored_batches(spark, sf_dir, "l_orderkey")
    merged, head = G.regroup(inst, parts, ["l_orderkey", "url", "confidence"], spent=(rows,))
    drop_stored(parts)
    return G.group_summary(merged).join(head, G.KEY).select(*G.KEY, "n_instances", "max_conf", "arg1_fbid", "arg2_fbid")


@register("inc1_upsert_groups", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS, S.BATCHED) + """,
keys AS (SELECT arg1, rel, arg2, max(CASE WHEN batch < 12 THEN 1 ELSE 0 END) = 1 AS in_existing,
                max(CASE WHEN batch = 12 THEN 1 ELSE 0 END) = 1 AS in_incoming
         FROM exb GROUP BY arg1, rel, arg2)
SELECT g.arg1, g.rel, g.arg2, g.n_instances, k.in_existing, k.in_incoming,
       k.in_incoming AS relink
FROM grp g JOIN keys k ON g.arg1 = k.arg1 AND g.rel = k.rel AND g.arg2 = k.arg2""")
def inc1_upsert_groups(spark, sf_dir):
    from factweave.streaming.upsert import merge_batch
    inst, parts, rows = stored_batches(spark, sf_dir)  # which groups are linked decides whose parts come first
    existing = (inst.filter("batch < 12"), parts.filter("batch < 12"))
    incoming = (inst.filter("batch = 12"), parts.filter("batch = 12"))
    merged, head, flags = merge_batch(existing, incoming, incoming_batch=12, columns=["url", "confidence"], spent=(rows,))
    drop_stored(parts)
    return G.group_summary(merged).join(flags, G.KEY).select(*G.KEY, "n_instances", "in_existing", "in_incoming",
                                                              "relink")


# ---------------------------------------------------------------------------
# attach types, lookups, filters
# ---------------------------------------------------------------------------

from factweave.functions import arg_string_ok, clean_control, filter_types, rel_string_ok  # noqa: E402
from factweave.operators import attach as AT  # noqa: E402
from factweave.operators.skew import spread_join  # noqa: E402
from factweave.operators.score import span_valid  # noqa: E402


@register("jn2_attach_types", TYPING_SQL + f"""
SELECT t.arg1, t.rel, t.arg2, t.row_id, t.arg1_fbid,
       array_to_string(CASE WHEN p.pt IS NOT NULL AND len({S.filt_types('t.arg1_types')}) = 0 THEN p.pt
                            ELSE t.arg1_types END, ',') AS arg1_types,
       (p.pt IS NOT NULL AND len({S.filt_types('t.arg1_types')}) = 0) AS types_attached
FROM tuples t
LEFT JOIN (SELECT arg, list_sort(list(DISTINCT type)) AS pt FROM ttypes GROUP BY arg) p
  ON t.arg1 = p.arg""")
def jn2_attach_types(spark, sf_dir):
    tup, dim = typing_inputs(spark, sf_dir)
    pred = T.predict_types(tup, TYPING, dim)
    out = AT.attach_types(tup, pred, "arg1")
    return out.select("arg1", "rel", "arg2", "row_id", "arg1_fbid", F.array_join("arg1_types", ",").alias("arg1_types"),
                      "types_attached")


@register("jn3_spread_join", S.with_(S.TYPE_DIM, S.EXTRACTIONS, S.TUPLES) + """
SELECT t.row_id, t.arg1, t.rel, r.n_args FROM tuples t
LEFT JOIN (SELECT rel, count(DISTINCT arg1) AS n_args FROM tuples WHERE len(arg1_types) > 0 GROUP BY rel) r ON t.rel = r.rel""")
def jn3_spread_join(spark, sf_dir):
    """Every tuple with the number of typed arguments of its relation; a relation holds a large share of all tuples."""
    tup = FX.tuples(spark, sf_dir)
    rels = tup.filter(F.size("arg1_types") > 0).groupBy("rel").agg(F.countDistinct("arg1").alias("n_args"))
    return spread_join(tup, rels, "rel", "left", partitions=64).select("row_id", "arg1", "rel", "n_args")


@register("jn4_type_lookup", S.with_(S.TYPE_DIM, S.EXTRACTIONS, S.TUPLES) + """
SELECT t.type, d.enum, count(*) AS n FROM (SELECT unnest(arg1_types) AS type FROM tuples) t
LEFT JOIN tdim d ON t.type = d.type GROUP BY t.type, d.enum""")
def jn4_type_lookup(spark, sf_dir):
    tup, dim = typing_inputs(spark, sf_dir)
    ts = tup.select(F.explode("arg1_types").alias("type"))
    known, unknown = AT.types_to_ints(ts, dim)
    return known.unionByName(unknown.withColumn("enum", F.lit(None).cast("int"))) \
        .groupBy("type", "enum").agg(F.count(F.lit(1)).alias("n"))


@register("pf2_type_filter", S.with_(S.EXTRACTIONS, S.TUPLES) + f"""
SELECT array_to_string(arg1_types, ',') AS raw, array_to_string({S.filt_types('arg1_types')}, ',') AS kept, count(*) AS n
FROM tuples GROUP BY ALL""")
def pf2_type_filter(spark, sf_dir):
    tup = FX.tuples(spark, sf_dir)
    return tup.groupBy(F.array_join("arg1_types", ",").alias("raw"),
                       F.array_join(filter_types("arg1_types"), ",").alias("kept")).agg(F.count(F.lit(1)).alias("n"))


@register("pf3_arg_filter", S.with_(S.EXTRACTIONS, S.TUPLES) + f"""
SELECT role, arg, {S.arg_ok('arg')} AS ok, count(*) AS n FROM (
  SELECT 'arg1' AS role, arg1 AS arg FROM tuples UNION ALL SELECT 'arg2' AS role, arg2 AS arg FROM tuples
) GROUP BY role, arg""")
def pf3_arg_filter(spark, sf_dir):
    tup = FX.tuples(spark, sf_dir)
    a = tup.select(F.lit("arg1").alias("role"), F.col("arg1").alias("arg")) \
        .unionByName(tup.select(F.lit("arg2").alias("role"), F.col("arg2").alias("arg")))
    return a.groupBy("role", "arg").agg(F.count(F.lit(1)).alias("n")).withColumn("ok", arg_string_ok("arg"))


def stoplist(spark, sf_dir):
    """Entity stop list for the fixture: part entities whose key is divisible by 11."""
    return FX.read(spark, sf_dir, "part").filter(F.col("p_partkey") % 11 == 0) \
        .select(F.concat(F.lit("m."), F.col("p_partkey").cast("string")).alias("fbid"))


@register("pf4_entity_filter", S.with_(S.EXTRACTIONS, S.TUPLES, *S.typing_ctes("arg1")) + """
SELECT l.rel, l.n_linked, coalesce(k.n_kept, 0) AS n_kept FROM
  (SELECT rel, count(*) AS n_linked FROM tuples WHERE arg1_fbid IS NOT NULL GROUP BY rel) l
LEFT JOIN (SELECT rel, count(*) AS n_kept FROM ent
           WHERE fbid NOT IN (SELECT 'm.' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 11 = 0)
           GROUP BY rel) k ON l.rel = k.rel""")
def pf4_entity_filter(spark, sf_dir):
    tup, dim = typing_inputs(spark, sf_dir)
    ent = T.entity_occurrences(tup, TYPING, dim, stoplist=stoplist(spark, sf_dir))
    linked_n = tup.filter(F.col("arg1_fbid").isNotNull()).groupBy("rel").agg(F.count(F.lit(1)).alias("n_linked"))
    kept = ent.groupBy("rel").agg(F.count(F.lit(1)).alias("n_kept"))
    return linked_n.join(kept, "rel", "left").select("rel", "n_linked", F.coalesce("n_kept", F.lit(0)).alias("n_kept"))


@register("pf5_relation_filter", TYPING_SQL + f"""
SELECT rel, n_sample, weight,
       (length(rel) >= {S.C.MIN_REL_LENGTH} AND length(rel) <= {S.C.MAX_REL_LENGTH} AND n_sample > 0
        AND weight >= CAST(0.1 AS DOUBLE)) AS kept
FROM stats2""")
def pf5_relation_filter(spark, sf_dir):
    """The relation filter on the weight of all occurrences."""
    tup, dim = typing_inputs(spark, sf_dir)
    st = T.relation_stats(T.entity_occurrences(tup, TYPING, dim))
    return st.select("rel", "n_sample", "weight",
                     (rel_string_ok("rel") & (F.col("n_sample") > 0) & (F.col("weight") >= F.lit(TYPING.min_rel_weight))).alias("kept"))


@register("pf7_clean_control", """
SELECT doc_id, length(text) AS n_before, length(c) AS n_after, md5(c) AS h
FROM (SELECT doc_id, text, regexp_replace(replace(text, chr(9), ' '), '\\p{C}', '', 'g') AS c FROM documents)""")
def pf7_clean_control(spark, sf_dir):
    d = FX.read(spark, sf_dir, "documents").select("doc_id", "text")
    c = clean_control("text")
    return d.select("doc_id", F.length("text").alias("n_before"), F.length(c).alias("n_after"), F.md5(c).alias("h"))


@register("pf8_span_validity", S.with_(S.EXTRACTIONS) + """
SELECT l_orderkey, l_linenumber, arg2s, valid, count(*) AS n FROM (
  SELECT l_orderkey, l_linenumber, arg2_start + CAST(l_linenumber % 3 AS INTEGER) AS arg2s,
         arg1_start >= 0 AND arg1_len > 0 AND arg1_start + arg1_len <= len(tokens)
     AND rel_start >= 0 AND rel_len > 0 AND rel_start + rel_len <= len(tokens)
     AND arg2_start + CAST(l_linenumber % 3 AS INTEGER) >= 0 AND arg2_len > 0
     AND arg2_start + CAST(l_linenumber % 3 AS INTEGER) + arg2_len <= len(tokens) AS valid
  FROM ex) GROUP BY ALL""")
def pf8_span_validity(spark, sf_dir):
    ex = FX.extractions(spark, sf_dir).withColumn("arg2_start", F.col("arg2_start") + (F.col("l_linenumber") % 3).cast("int"))
    return ex.groupBy("l_orderkey", "l_linenumber", F.col("arg2_start").alias("arg2s"), span_valid().alias("valid")) \
        .agg(F.count(F.lit(1)).alias("n"))


SAMPLE_FRACTION = 0.1


def md5_threshold(frac: float) -> str:
    return format(int(frac * 16**8), "08x")


@register("pf9_sample_groups", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + f"""
SELECT arg1, rel, arg2, n_instances FROM grp
WHERE substr(md5(concat_ws('|', arg1, rel, arg2)), 1, 8) < '{md5_threshold(SAMPLE_FRACTION)}'""")
def pf9_sample_groups(spark, sf_dir):
    from factweave.operators.filters import bernoulli_sample
    g = summary(spark, sf_dir).select(*G.KEY, "n_instances")
    return bernoulli_sample(g, SAMPLE_FRACTION, G.KEY)


@register("pf12_surface_strings", S.with_(S.EXTRACTIONS) + f"""
SELECT url, array_to_string(tokens, ' ') AS sentence,
       {', '.join(f"array_to_string({S.sl('tokens', p + '_start', p + '_len')}, ' ') AS {p}_text" for p in ('arg1', 'rel', 'arg2'))}
FROM ex""")
def pf12_surface_strings(spark, sf_dir):
    from factweave.functions import span_text
    ex = FX.extractions(spark, sf_dir)
    return ex.select("url", F.array_join("tokens", " ").alias("sentence"),
                     *[span_text("tokens", f"{p}_start", f"{p}_len").alias(f"{p}_text") for p in ("arg1", "rel", "arg2")])


# ---------------------------------------------------------------------------
# text -> triples (TX1-TX4) and E1 end to end on documents
# ---------------------------------------------------------------------------

from factweave.operators import text as TX  # noqa: E402
from factweave.functions import span_text  # noqa: E402

TEXT_SQL = S.with_(S.text_ctes())
SPAN_COLS = ["arg1_start", "arg1_len", "rel_start", "rel_len", "arg2_start", "arg2_len"]


def doc_extractions(spark, sf_dir):
    return TX.document_extractions(FX.read(spark, sf_dir, "documents"))


@register("tx1_annotate", S.with_(S.text_ctes(), S.annotate_cte()) + """
SELECT doc_id, sentence, array_to_string(ptags, ' ') AS postags, array_to_string(chunks, ' ') AS chunks FROM ann""")
def tx1_annotate(spark, sf_dir):
    docs = FX.read(spark, sf_dir, "documents")
    a = TX.annotate(TX.sentences(docs, url_col=None))
    return a.select("doc_id", "sentence", F.array_join("postags", " ").alias("postags"),
                    F.array_join("chunks", " ").alias("chunks"))


@register("tx2_extract_triples", TEXT_SQL + f"""
SELECT url, sentence, {', '.join(SPAN_COLS)},
       {', '.join(f"array_to_string({S.sl('tokens', p + '_start', p + '_len')}, ' ') AS {p}_text" for p in ('arg1', 'rel', 'arg2'))}
FROM tex_raw""")
def tx2_extract_triples(spark, sf_dir):
    ex = doc_extractions(spark, sf_dir)
    return ex.select("url", "sentence", *SPAN_COLS,
                     *[span_text("tokens", f"{p}_start", f"{p}_len").alias(f"{p}_text") for p in ("arg1", "rel", "arg2")])


@register("tx3_confidence", TEXT_SQL + f"SELECT url, sentence, {', '.join(SPAN_COLS)}, confidence FROM tex")
def tx3_confidence(spark, sf_dir):
    return score(doc_extractions(spark, sf_dir)).select("url", "sentence", *SPAN_COLS, "confidence")


@register("tx4_normalize_keys", TEXT_SQL + f"SELECT url, sentence, {', '.join(SPAN_COLS)}, arg1, rel, arg2 FROM tex")
def tx4_normalize_keys(spark, sf_dir):
    return FX.with_norms(doc_extractions(spark, sf_dir)).select("url", "sentence", *SPAN_COLS, "arg1", "rel", "arg2")


@register("e1_sentences_to_groups", TEXT_SQL + """
SELECT arg1, rel, arg2, count(*) AS n_instances, count(DISTINCT url) AS n_urls,
       max(confidence) AS max_conf, min(confidence) AS min_conf
FROM tinst GROUP BY arg1, rel, arg2""")
def e1_sentences_to_groups(spark, sf_dir):
    ex = score(FX.with_norms(doc_extractions(spark, sf_dir)))
    return G.summarize(ex)


# ---------------------------------------------------------------------------
# linking (TX6, TX7, JN5-JN8, AG12)
# ---------------------------------------------------------------------------

from factweave.operators import linking as L  # noqa: E402

LINK_SQL = S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS, S.LINKED, S.LINK_TABLES, S.FIRST_INST, S.LINK_BEST)
LINK_OUT = ["arg1_fbid", "arg1_name", "arg1_score", "arg2_fbid", "arg2_name", "arg2_score"]


def linked_result(spark, sf_dir, min_freq: int = 0, min_arg_length: int = 0, fields: tuple[str, ...] = ("fbid", "name")):
    """(linked groups, their parts before), with the ``fields`` that the query reads; the scored rows, which grouping and linking
    both read, are stored once."""
    kept = [f"{r}_{c}" for r in ("arg1", "arg2") for c in fields]
    rows = cut_lineage(scored_rows(spark, sf_dir).select(*G.KEY, "tokens", *G.SPANS, F.unhex("inst_id").alias("inst_id"), *kept))
    parts, frequent = G.first_instance_parts(rows, G.KEY, fields), None
    if min_freq:
        # the filter meets one row per group, never the instances with their tokens
        size = rows.select(*G.KEY, "inst_id").distinct().groupBy(*G.KEY).agg(F.count("inst_id").alias("n_instances"))
        frequent = cut_lineage(G.frequency_filter(size, min_freq=min_freq).select(*G.KEY))
        parts = parts.join(frequent, G.KEY, "left_semi")
    parts = cut_lineage(parts)  # read by the linking, and beside its result where links are compared
    anchors, ents = map(cut_lineage, FX.link_tables(spark, sf_dir))  # a knowledge base is stored tables
    return L.link_groups(rows, parts, anchors, ents, min_arg_length=min_arg_length, only=frequent), parts


@register("jn6_link_groups", LINK_SQL + f"SELECT arg1, rel, arg2, {', '.join(LINK_OUT)} FROM linked")
def jn6_link_groups(spark, sf_dir):
    return linked_result(spark, sf_dir)[0].select(*G.KEY, *LINK_OUT)


@register("jn7_link_frequent_groups", LINK_SQL + f"""
SELECT l.arg1, l.rel, l.arg2, {', '.join('l.' + c for c in LINK_OUT)} FROM linked l
JOIN grp g ON l.arg1 = g.arg1 AND l.rel = g.rel AND l.arg2 = g.arg2 WHERE g.n_instances >= 2""")
def jn7_link_frequent_groups(spark, sf_dir):
    return linked_result(spark, sf_dir, min_freq=2)[0].select(*G.KEY, *LINK_OUT)


PF13_LENGTH = 16  # binds on the fixture: part names have 9 to 24 letters, supplier names 18


@register("pf13_min_link_length", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS, S.LINKED, S.LINK_TABLES, S.FIRST_INST, S.link_best(PF13_LENGTH))
          + f"SELECT arg1, rel, arg2, {', '.join(LINK_OUT)} FROM linked")
def pf13_min_link_length(spark, sf_dir):
    """Linking with a minimum length: shorter head phrases stay without a link."""
    return linked_result(spark, sf_dir, min_arg_length=PF13_LENGTH)[0].select(*G.KEY, *LINK_OUT)


@register("jn5_link_arguments", LINK_SQL + """
SELECT arg1, rel, arg2, role, struct_extract(b, 'fbid') AS fbid, struct_extract(b, 'score') AS score FROM best""")
def jn5_link_arguments(spark, sf_dir):
    out, _ = linked_result(spark, sf_dir, fields=("fbid",))
    sides = F.explode(F.array(*[F.struct(F.lit(x).alias("role"), F.col(f"{x}_fbid").alias("fbid"), F.col(f"{x}_score").alias("score")) for x in ("arg1", "arg2")]))
    return out.select(*G.KEY, sides.alias("s")).select(*G.KEY, "s.*").filter(F.col("fbid").isNotNull())


@register("tx6_head_phrases", LINK_SQL + "SELECT arg_text, head FROM heads")
def tx6_head_phrases(spark, sf_dir):
    anchors, _ = FX.link_tables(spark, sf_dir)
    rep = L.head_phrase_report(scored_rows(spark, sf_dir), anchors)
    return rep.select("arg_text", "head").distinct()


@register("tx7_head_phrase_report", LINK_SQL + """
SELECT r.arg1, r.rel, r.arg2, r.role, r.arg_text, h.head FROM roles r JOIN heads h ON r.arg_text = h.arg_text""")
def tx7_head_phrase_report(spark, sf_dir):
    anchors, _ = FX.link_tables(spark, sf_dir)
    return L.head_phrase_report(scored_rows(spark, sf_dir), anchors).select(*G.KEY, "role", "arg_text", "head")


@register("ag12_link_diff", LINK_SQL + """
SELECT role,
       count_if(b IS NOT NULL) AS links_before, count_if(a IS NOT NULL) AS links_after,
       count_if(b IS NULL AND a IS NOT NULL) AS new_links, count_if(b IS NOT NULL AND a IS NULL) AS lost_links,
       count_if(b IS NOT NULL AND a IS NOT NULL AND a <> b) AS changed_links,
       count(DISTINCT b) AS fbids_before, count(DISTINCT a) AS fbids_after
FROM (SELECT 'arg1' AS role, p.arg1_fbid AS b, l.arg1_fbid AS a FROM lg p FULL OUTER JOIN linked l
        ON p.arg1 = l.arg1 AND p.rel = l.rel AND p.arg2 = l.arg2
      UNION ALL
      SELECT 'arg2', p.arg2_fbid, l.arg2_fbid FROM lg p FULL OUTER JOIN linked l
        ON p.arg1 = l.arg1 AND p.rel = l.rel AND p.arg2 = l.arg2)
GROUP BY role""")
def ag12_link_diff(spark, sf_dir):
    out, parts = linked_result(spark, sf_dir, fields=("fbid",))
    return L.link_diff(parts, cut_lineage(out.select(*G.KEY, "arg1_fbid", "arg2_fbid")))


@register("ag12_link_changes", LINK_SQL + """
SELECT DISTINCT role, CASE WHEN b IS NULL THEN 'new' WHEN a IS NULL THEN 'lost' ELSE 'changed' END AS kind, argument,
       b AS fbid_before, a AS fbid_after
FROM (SELECT 'arg1' AS role, p.arg1 AS argument, p.arg1_fbid AS b, l.arg1_fbid AS a FROM lg p JOIN linked l
        ON p.arg1 = l.arg1 AND p.rel = l.rel AND p.arg2 = l.arg2
      UNION ALL
      SELECT 'arg2', p.arg2, p.arg2_fbid, l.arg2_fbid FROM lg p JOIN linked l ON p.arg1 = l.arg1 AND p.rel = l.rel AND p.arg2 = l.arg2)
WHERE b IS DISTINCT FROM a""")
def ag12_link_changes(spark, sf_dir):
    out, parts = linked_result(spark, sf_dir, fields=("fbid",))
    return L.link_changes(parts, cut_lineage(out.select(*G.KEY, "arg1_fbid", "arg2_fbid")))


# ---------------------------------------------------------------------------
# record formats (SRC3, SRC4, SRC6-SRC8)
# ---------------------------------------------------------------------------

from factweave.sources import records as RC  # noqa: E402

REC_SQL = S.with_(S.text_ctes(), S.annotate_cte(), S.record_ctes())


def text_records(spark, sf_dir):
    ex = score(FX.with_norms(doc_extractions(spark, sf_dir)))
    ex = TX.with_chunks(ex.withColumn("postags", F.transform("tokens", TX.penn_tag)))
    sent = F.replace(F.col("sentence"), F.lit("\t"), F.lit(" "))
    sp = lambda c, p: span_text(c, f"{p}_start", f"{p}_len")
    return ex.select(
        F.col("url").alias("docname"), F.lit("relphrase").alias("extractorType"), F.col("arg1_start").alias("sentenceid"),
        F.col("rel_start").alias("eid"), "url", F.md5(sent).alias("hashes"), "confidence",
        sp("tokens", "arg1").alias("arg1"), sp("tokens", "rel").alias("rel"), sp("tokens", "arg2").alias("arg2"),
        F.col("arg1").alias("norm1Arg1"), F.col("rel").alias("norm1Rel"), F.col("arg2").alias("norm1Arg2"),
        sp("tokens", "arg1").alias("norm2Arg1"), sp("tokens", "rel").alias("norm2Rel"), sp("tokens", "arg2").alias("norm2Arg2"),
        sp("postags", "arg1").alias("norm1Arg1PosTags"), sp("postags", "rel").alias("norm1RelPosTags"),
        sp("postags", "arg2").alias("norm1Arg2PosTags"),
        sp("postags", "arg1").alias("norm2Arg1PosTags"), sp("postags", "rel").alias("norm2RelPosTags"),
        sp("postags", "arg2").alias("norm2Arg2PosTags"),
        F.lit("ARG1").alias("arg1Tag"), F.lit("REL").alias("relTag"), F.lit("ARG2").alias("arg2Tag"),
        F.concat_ws("\t", sent, F.array_join("tokens", " "), F.array_join("postags", " "),
                    F.array_join("chunks", " ")).alias("dataString"))


def record_lines(spark, sf_dir):
    fields = F.split("value", "\t", -1)
    at = {c: fields[RC.RECORD_FIELDS.index(c)] for c in ("docname", "eid")}
    bad = F.array_join(F.slice(fields, 1, 20), "\t")
    return RC.write_records(text_records(spark, sf_dir)) \
        .select(at["docname"].alias("docname"), F.when(at["eid"].cast("int") % 7 == 0, bad).otherwise(F.col("value")).alias("value"))


@register("src8_write_records", REC_SQL + "SELECT docname, value FROM rec_lines")
def src8_write_records(spark, sf_dir):
    return record_lines(spark, sf_dir)


@register("src6_read_records", REC_SQL + "SELECT * FROM rec_parsed")
def src6_read_records(spark, sf_dir):
    return RC.read_records(record_lines(spark, sf_dir))


@register("src7_record_derived", REC_SQL + """
SELECT docname, sentenceid, eid, norm1Arg1 || chr(9) || norm1Rel || chr(9) || norm1Arg2 AS norm1String,
       norm2Arg1 || chr(9) || norm2Rel || chr(9) || norm2Arg2 AS norm2String,
       arg1Tag || chr(9) || relTag || chr(9) || arg2Tag AS tagString,
       string_split(dataString, chr(9))[1] AS sentence,
       trim(string_split(dataString, chr(9))[3]) AS posTags, trim(string_split(dataString, chr(9))[4]) AS chunkTags
FROM rec_parsed""")
def src7_record_derived(spark, sf_dir):
    d = RC.record_derived(RC.read_records(record_lines(spark, sf_dir)))
    return d.select("docname", "sentenceid", "eid", "norm1String", "norm2String", "tagString", "sentence",
                    F.array_join("posTags", " ").alias("posTags"), F.array_join("chunkTags", " ").alias("chunkTags"))


@register("src3_raw_sentences", """
SELECT p[1] AS sentence, p[2] AS url FROM (
  SELECT string_split(CASE doc_id % 3 WHEN 0 THEN line WHEN 1 THEN line || chr(9) || source
                           ELSE line || chr(9) || source || chr(9) || lang END, chr(9)) AS p
  FROM (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line FROM documents))
WHERE len(p) >= 2""")
def src3_raw_sentences(spark, sf_dir):
    d = FX.read(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.explode(F.split("text", "\n", -1)).alias("line"))
    m = F.col("doc_id") % 3
    v = F.when(m == 0, F.col("line")).when(m == 1, F.concat_ws("\t", "line", "source")) \
        .otherwise(F.concat_ws("\t", "line", "source", "lang"))
    return RC.read_raw_sentences(d.select(v.alias("value")))


@register("src4_layered_sentences", S.with_(S.text_ctes(), S.annotate_cte()) + """
SELECT url, len(tk) AS n_tokens, array_to_string(tk, ' ') AS tokens FROM (
  SELECT string_split_regex(p[1], '\\s') AS tk, string_split_regex(p[2], '\\s') AS pt, string_split_regex(p[3], '\\s') AS ch,
         p[4] AS url
  FROM (SELECT string_split(concat_ws(chr(9), array_to_string(tokens, ' '), array_to_string(ptags, ' '),
               array_to_string(CASE WHEN doc_id % 5 = 0 THEN list_slice(chunks, 1, len(chunks) - 1) ELSE chunks END, ' '),
               CAST(doc_id AS VARCHAR)), chr(9)) AS p FROM ann)
  WHERE len(p) >= 4)
WHERE len(tk) = len(pt) AND len(pt) = len(ch)""")
def src4_layered_sentences(spark, sf_dir):
    docs = FX.read(spark, sf_dir, "documents")
    a = TX.annotate(TX.sentences(docs, url_col=None))
    a = a.withColumn("chunks", F.when(F.col("doc_id") % 5 == 0, F.slice("chunks", 1, F.greatest(F.size("chunks") - 1, F.lit(0))))
                     .otherwise(F.col("chunks"))).withColumn("url", F.col("doc_id").cast("string"))
    r = RC.read_layered(RC.write_layered(a))
    return r.select("url", F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


# ---------------------------------------------------------------------------
# lookups, compositions, bounded reads, counters
# ---------------------------------------------------------------------------

@register("jn9_find_groups", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS, S.BATCHED) + """
SELECT DISTINCT arg1, rel, arg2 FROM exb e WHERE batch < 12
  AND EXISTS (SELECT 1 FROM exb i WHERE i.batch = 12 AND i.arg1 = e.arg1 AND i.rel = e.rel AND i.arg2 = e.arg2)""")
def jn9_find_groups(spark, sf_dir):
    """Identity query: existing (batches before 12) groups that an incoming (batch 12) group would hit."""
    inst, _ = batched(spark, sf_dir)
    existing, incoming = (inst.filter(c).select(*G.KEY).distinct() for c in ("batch < 12", "batch = 12"))
    return existing.join(incoming, G.KEY, "left_semi")


@register("jn8_group_and_link", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + "SELECT * FROM grp")
def jn8_group_and_link(spark, sf_dir):
    """Group + frequency filter 0..max; linking is skipped by default, as in the original job."""
    from factweave.plans.pipelines import group_and_link
    return group_and_link(scored_extractions(spark, sf_dir), link=False)


@register("tk4_bounded_read", """
SELECT doc_id, lang, rank FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 100""")
def tk4_bounded_read(spark, sf_dir):
    """First n rows per input file (n = 100 documents by doc_id); the tables of the check are one file each."""
    from factweave.operators.caps import top_n_per_key
    d = FX.read(spark, sf_dir, "documents").select("doc_id", "lang", F.input_file_name().alias("file"))
    return top_n_per_key(d, ["file"], [F.col("doc_id")], 100).select("doc_id", "lang", F.col("rank").cast("long").alias("rank"))


@register("ag13_run_counters", S.with_(S.EXTRACTIONS) + """
SELECT count(*) AS rows, count(arg1_fbid) AS arg1_linked, count(arg2_fbid) AS arg2_linked, count_if(confidence IS NULL) AS invalid_spans
FROM ex""")
def ag13_run_counters(spark, sf_dir):
    """Counters observed while the rows flow into their sink (rows, linked, invalid spans), as the run reports them."""
    from factweave.streaming.ingest import run_counters
    rows, obs = run_counters(scored_extractions(spark, sf_dir), "extractions")
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([obs.get], "rows long, arg1_linked long, arg2_linked long, invalid_spans long")


@register("src17_new_files", """
WITH f AS (SELECT page_id, url AS path, length(html) AS length, split_part(regexp_extract(url, '[^/]*$'), '.', 1) AS stem FROM pages)
SELECT path, length, stem FROM f s WHERE page_id % 2 = 0
  AND NOT EXISTS (SELECT 1 FROM f t WHERE t.page_id % 2 = 1 AND t.length > 0 AND t.stem = s.stem)""")
def src17_new_files(spark, sf_dir):
    """SRC17 + JN10 + ST4 over page addresses: the even pages are the source listing, the odd ones the target."""
    from factweave.streaming.ingest import new_files
    f = FX.read(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"), F.length("html").cast("long").alias("length"))
    return new_files(f.filter("page_id % 2 = 0").drop("page_id"), f.filter("page_id % 2 = 1")).select("path", "length", "stem")


@register("jn4_types_to_strings", S.with_(S.TYPE_DIM) + """
SELECT e.type_enum, d.type FROM (SELECT enum AS type_enum FROM tdim UNION ALL SELECT enum + 7 FROM tdim) e JOIN tdim d ON e.type_enum = d.enum""")
def jn4_types_to_strings(spark, sf_dir):
    """JN4, number to string: numbers that no type has are dropped."""
    dim = FX.type_dim(spark, sf_dir)
    ints = dim.select(F.col("enum").alias("type_enum")).unionByName(dim.select((F.col("enum") + 7).alias("type_enum")))
    return AT.types_to_strings(ints, dim).select("type_enum", "type")


# ---------------------------------------------------------------------------
# typer text formats (SRC5, SRC9, SRC11-SRC14)
# ---------------------------------------------------------------------------

from factweave.sources import codecs as CD  # noqa: E402

RELINFO_LINES = f"""ent_enum AS (
  SELECT e.rel, e.fbid, e.tkey, list_sort(list(d.enum)) AS enums
  FROM (SELECT rel, fbid, tkey, unnest(types) AS type FROM rel_ent WHERE rel IN (SELECT rel FROM relinfo)) e
  JOIN tdim d ON e.type = d.type GROUP BY e.rel, e.fbid, e.tkey
),
rl AS (
  SELECT r.rel, array_to_string(list_transform(list_concat([r.rel, printf('%.2f', r.weight_2dp)], x.es),
                                               lambda p: replace(p, ':', '_COLON_')), ':') AS line
  FROM relinfo r JOIN (
    SELECT e.rel, CAST('0x' || substr(md5(concat_ws('|', e.fbid, e.tkey)), 1, 8) AS BIGINT) % ((i.n_entities + {CD.ENTITIES_PER_LINE - 1}) // {CD.ENTITIES_PER_LINE}) AS line_no,
           list(concat_ws(',', fbid, array_to_string(list_transform(enums, lambda v: CAST(v AS VARCHAR)), ',')) ORDER BY fbid, tkey) AS es
    FROM ent_enum e JOIN relinfo i ON e.rel = i.rel GROUP BY e.rel, line_no) x ON r.rel = x.rel
)"""

PRED_LINES = """plines AS (
  SELECT t.arg, concat_ws(chr(9), replace(t.arg, chr(9), '_TAB_'), replace(t.types_s, chr(9), '_TAB_'), replace(coalesce(n.rels, ''), chr(9), '_TAB_'),
                          CAST(CAST(tt.total_weight AS DECIMAL(38,2)) AS VARCHAR), replace(f.fbids, chr(9), '_TAB_')) AS value,
         t.types_s, CAST(CAST(CAST(tt.total_weight AS DECIMAL(38,2)) AS VARCHAR) AS DOUBLE) AS total_weight, f.fbids
  FROM (SELECT arg, string_agg(replace(type, '@', '_ATSYM_') || '@' || CAST(share AS VARCHAR), ', ' ORDER BY share DESC, enum) AS types_s
        FROM ttypes GROUP BY arg) t
  JOIN totals tt ON t.arg = tt.arg
  JOIN (SELECT arg, string_agg(fbid, ',' ORDER BY rank) AS fbids FROM top WHERE rank <= 5 GROUP BY arg) f ON t.arg = f.arg
  LEFT JOIN (SELECT arg, string_agg(replace(rel, ':', '_COLON_') || ':' || printf('%.2f', weight_2dp), ', ' ORDER BY weight_2dp DESC, rel) AS rels
             FROM (SELECT *, row_number() OVER (PARTITION BY arg ORDER BY weight_2dp DESC, rel) AS rn FROM ar) WHERE rn <= 4 GROUP BY arg) n
    ON t.arg = n.arg
)"""


@register("src12_relinfo_codec", S.with_(*TYPING_CTES, RELINFO_LINES) + "SELECT rel, line FROM rl")
def src12_relinfo_codec(spark, sf_dir):
    p1, dim = typing_tables(spark, sf_dir)
    return CD.relation_lines(p1.rel_info, p1.rel_ent, dim)


@register("src12_relinfo_decode", S.with_(*TYPING_CTES, RELINFO_LINES) + """
SELECT e.rel, r.weight_2dp AS weight, e.fbid, array_to_string(list_transform(e.enums, lambda v: CAST(v AS VARCHAR)), ',') AS enums
FROM ent_enum e JOIN relinfo r ON e.rel = r.rel""")
def src12_relinfo_decode(spark, sf_dir):
    """Every line of every relation read back: its entities, one row each."""
    p1, dim = typing_tables(spark, sf_dir)
    d = CD.decode_rel_info(CD.relation_lines(p1.rel_info, p1.rel_ent, dim)).select("rel", "weight", F.explode("entities").alias("e"))
    return d.select("rel", "weight", "e.fbid", F.array_join(F.transform("e.enums", lambda x: x.cast("string")), ",").alias("enums"))


@register("src11_phase_one_lines", S.with_(*TYPING_CTES, RELINFO_LINES) + """
SELECT chr(9) || replace(line, chr(9), '_TAB_') AS value FROM rl
UNION ALL
SELECT replace(a.arg, chr(9), '_TAB_') || chr(9) || replace(replace(a.rel, ':', '_COLON_') || ':' || printf('%.2f', a.weight_2dp), chr(9), '_TAB_')
FROM ar a""")
def src11_phase_one_lines(spark, sf_dir):
    p1, dim = typing_tables(spark, sf_dir)
    return CD.phase_one_lines(p1.arg_rel, CD.relation_lines(p1.rel_info, p1.rel_ent, dim))


@register("src11_phase_two_from_lines", TYPING_SQL + "SELECT * FROM pred")
def src11_phase_two_from_lines(spark, sf_dir):
    """Phase two from the text form of phase one: written to the shared folder, read back and typed."""
    p1, dim = typing_tables(spark, sf_dir)
    path = scratch_path(spark, "phase-one-lines")
    CD.phase_one_lines(p1.arg_rel, CD.relation_lines(p1.rel_info, p1.rel_ent, dim)).write.text(path)
    return T.flat_predictions(T.phase_two(CD.read_phase_one_lines(spark.read.text(path), dim), TYPING, dim))


@register("stage_two_stored_phase_one", TYPING_SQL + "SELECT * FROM pred")
def stage_two_stored_phase_one(spark, sf_dir):
    """Stage selection: phase one written by one call, phase two run by another from its files alone."""
    tup, dim = typing_inputs(spark, sf_dir)
    path = scratch_path(spark, "phase-one")
    T.predict_types(tup, TYPING, dim, stage="one", stored=path)
    return T.flat_predictions(T.predict_types(None, TYPING, dim, stage="two", stored=path))


@register("src13_prediction_text", S.with_(*TYPING_CTES, PRED_LINES) + "SELECT arg, value FROM plines")
def src13_prediction_text(spark, sf_dir):
    tup, dim = typing_inputs(spark, sf_dir)
    return CD.encode_prediction(T.predict_types(tup, dataclasses.replace(TYPING, keep_rel_string=True), dim))


@register("src14_prediction_parse", S.with_(*TYPING_CTES, PRED_LINES) + """
SELECT arg, types_s AS types, total_weight, fbids AS top_fbids FROM plines
WHERE substr(md5(arg), 1, 1) NOT IN ('0', '1')""")
def src14_prediction_parse(spark, sf_dir):
    """Lines of args whose md5 starts with '0' carry only an unknown type, with '1' lose
    their last column: both kinds are dropped by the parser."""
    tup, dim = typing_inputs(spark, sf_dir)
    lines = CD.encode_prediction(T.predict_types(tup, TYPING, dim))
    parts = F.split("value", "\t", -1)
    h = F.substring(F.md5("arg"), 1, 1)
    bad_type = F.array_join(F.concat(F.slice(parts, 1, 1), F.array(F.lit("/misc/unknown@3")), F.slice(parts, 3, 3)), "\t")
    short = F.array_join(F.slice(parts, 1, 4), "\t")
    lines = lines.select(F.when(h == "0", bad_type).when(h == "1", short).otherwise(F.col("value")).alias("value"))
    d = CD.decode_prediction(lines, dim)
    return d.select("arg", F.array_join(F.transform("types", lambda t: F.concat(t["type"], F.lit("@"), t["share"].cast("string"))),
                                        ", ").alias("types"),
                    "total_weight", F.array_join("top_fbids", ",").alias("top_fbids"))


@register("src9_type_dictionary", S.with_(S.TYPE_DIM) + "SELECT enum, type, instances FROM tdim")
def src9_type_dictionary(spark, sf_dir):
    dim = FX.type_dim(spark, sf_dir)
    bad = spark.range(1).select(F.lit("x\t/broken").alias("value"))  # too few fields: dropped
    return CD.read_type_dim(CD.write_type_dim(dim).unionByName(bad))


@register("src5_group_records", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + "SELECT arg1, rel, arg2, n_instances FROM grp")
def src5_group_records(spark, sf_dir):
    nested = G.nest_groups(grouped(spark, sf_dir))
    back = CD.groups_from_json(CD.groups_to_json(nested), nested.schema)
    return back.select(F.col("arg1.norm").alias("arg1"), F.col("rel.norm").alias("rel"), F.col("arg2.norm").alias("arg2"),
                       F.size("instances").cast("long").alias("n_instances"))


# ---------------------------------------------------------------------------
# older extraction layout (SRC15) and bracket chunk text (SRC16)
# ---------------------------------------------------------------------------

from factweave.sources import old_layout as OL  # noqa: E402


def old_layout_lines(spark, sf_dir):
    """Text extractions written in the old layout: domain, bracketed sentence, arg1, rel,
    arg2 ranges as [start, end], url path. Rows with (arg1_start + rel_len) % 11 = 0 get a
    three-number arg2 range and rows with % 13 = 0 an arg2 range past the sentence end:
    both must be dropped."""
    docs = FX.read(spark, sf_dir, "documents")
    ex = TX.with_chunks(TX.document_extractions(docs).withColumn("postags", F.transform("tokens", TX.penn_tag)))
    rng = lambda s, ln: F.concat(F.lit("["), s.cast("string"), F.lit(", "), (s + ln).cast("string"), F.lit("]"))
    m = (F.col("arg1_start") + F.col("rel_len"))
    a2 = F.when(m % 11 == 0, F.concat(F.lit("[1, 2, "), F.col("arg2_start").cast("string"), F.lit("]"))) \
        .when(m % 13 == 0, rng(F.size("tokens"), F.col("arg2_len"))) \
        .otherwise(rng(F.col("arg2_start"), F.col("arg2_len")))
    dom = F.concat(F.lit("http://"), F.substring_index("url", "/", 1))
    path = F.concat(F.lit("/"), F.substring_index("url", "/", -1))
    return ex.select(F.concat_ws("\t", dom, OL.to_bracketed(), rng(F.col("arg1_start"), F.col("arg1_len")),
                                 rng(F.col("rel_start"), F.col("rel_len")), a2, path).alias("value"))


def read_old_layout(lines):
    return OL.convert_old_layout(lines, arg1_col=2, rel_col=3, arg2_col=4, sent_col=1, url_dom_col=0, url_path_col=5)


@register("inc6_line_ingest", S.with_(S.text_ctes()) + """
SELECT arg1, rel, arg2, count(*) AS n FROM (
  SELECT DISTINCT arg1, rel, arg2, tokens, arg1_start, arg1_len, rel_start, rel_len, arg2_start, arg2_len, url FROM tex
  WHERE (arg1_start + rel_len) % 11 <> 0 AND (arg1_start + rel_len) % 13 <> 0) GROUP BY arg1, rel, arg2
UNION ALL
SELECT NULL, 'skipped lines', NULL, count(*) FROM tex WHERE (arg1_start + rel_len) % 11 = 0 OR (arg1_start + rel_len) % 13 = 0""")
def inc6_line_ingest(spark, sf_dir):
    """INC6: lines to groups (their sizes), and how many lines the converter skipped."""
    # parsed once, two-sided: the extractions and the lines skipped come from the same stored rows
    parsed = cut_lineage(parse_old_layout(old_layout_lines(spark, sf_dir)).select("tokens", *G.SPANS, "url", "corpus", "reason"))
    good = FX.with_norms(parsed.filter(F.col("reason").isNull()).drop("reason"))
    groups = G.summarize(score(good)).select(*G.KEY, F.col("n_instances").alias("n"))
    none = F.lit(None).cast("string")
    skipped = parsed.agg(F.count("reason").alias("n")).select(none.alias("arg1"), F.lit("skipped lines").alias("rel"), none.alias("arg2"), "n")
    return groups.unionByName(skipped)


VALID_LINE = "(arg1_start + rel_len) % 11 <> 0 AND (arg1_start + rel_len) % 13 <> 0"


def parse_old_layout(lines):
    """Two-sided reader of the old layout: extractions, or what is wrong with a line."""
    x = OL.parse_old_layout(lines, arg1_col=2, rel_col=3, arg2_col=4, sent_col=1, url_dom_col=0, url_path_col=5)
    return x.withColumn("corpus", F.lit("documents"))


def ingested_lines(spark, sf_dir):
    """The fixture's old-layout lines as text files, taken in by the stream in two micro-batches or more; the table's folder."""
    from factweave.streaming.ingest import ingest
    work = scratch_path(spark, "line-ingest")
    lines = old_layout_lines(spark, sf_dir)
    short = F.md5("value").startswith("0")  # a sixteenth of the lines loses all but three columns
    lines = lines.select(F.when(short, F.array_join(F.slice(F.split("value", "\t", -1), 1, 3), "\t")).otherwise(F.col("value")).alias("value"))
    lines.repartition(6).write.text(f"{work}/lines")
    ingest(spark, f"{work}/lines", f"{work}/table", f"{work}/stream", reader=parse_old_layout, max_files_per_trigger=3, buckets=4)
    return f"{work}/table"


def old_line_sql() -> str:
    """The same lines in SQL: the md5 of a line decides which ones are cut short."""
    rng = "'[' || {p}_start || ', ' || ({p}_start + {p}_len) || ']'"
    word = "replace(replace(w, '[', '-LSB-'), ']', '-RSB-')"
    return f"""old_lines AS (
  SELECT *, substr(md5(concat_ws(chr(9), dom, bracketed, {rng.format(p='arg1')}, {rng.format(p='rel')}, a2, path)), 1, 1) = '0' AS short
  FROM (SELECT t.*, 'http://' || split_part(t.url, '/', 1) AS dom, '/' || split_part(t.url, '/', -1) AS path,
          CASE WHEN (t.arg1_start + t.rel_len) % 11 = 0 THEN '[1, 2, ' || t.arg2_start || ']'
               WHEN (t.arg1_start + t.rel_len) % 13 = 0 THEN '[' || len(t.tokens) || ', ' || (len(t.tokens) + t.arg2_len) || ']'
               ELSE {rng.format(p='t.arg2')} END AS a2,
          array_to_string(list_transform(a.tokens, lambda w, i:
            CASE WHEN starts_with(a.chunks[i], 'B-') THEN '[' || substr(a.chunks[i], 3) || ' ' ELSE '' END || {word} || '/' || a.ptags[i] ||
            CASE WHEN a.chunks[i] <> 'O' AND NOT coalesce(starts_with(a.chunks[i + 1], 'I-'), false) THEN ' ]' ELSE '' END), ' ') AS bracketed
        FROM tex t JOIN ann a ON t.doc_id = a.doc_id AND t.sid = a.sid))"""


@register("src18_file_ingest", S.with_(S.text_ctes(), S.annotate_cte(), old_line_sql()) + f"""
SELECT arg1, rel, arg2, count(*) AS n FROM (
  SELECT DISTINCT arg1, rel, arg2, tokens, arg1_start, arg1_len, rel_start, rel_len, arg2_start, arg2_len, url FROM old_lines
  WHERE NOT short AND {VALID_LINE}) GROUP BY arg1, rel, arg2""")
def src18_file_ingest(spark, sf_dir):
    """Text files to the stored table through the stream, read back merged: the size of every group."""
    from factweave.streaming.ingest import read_table
    return read_table(spark, ingested_lines(spark, sf_dir))[0].groupBy(*G.KEY).agg(F.count(F.lit(1)).alias("n"))


@register("inc4_ingest_rejects", S.with_(S.text_ctes(), S.annotate_cte(), old_line_sql()) + """
SELECT CASE WHEN short THEN 'too few columns' WHEN (arg1_start + rel_len) % 11 = 0 THEN 'range is not two integers'
            ELSE 'span outside the sentence' END AS reason, count(*) AS n
FROM old_lines WHERE short OR (arg1_start + rel_len) % 11 = 0 OR (arg1_start + rel_len) % 13 = 0 GROUP BY reason
UNION ALL SELECT 'counted', count(*) FROM old_lines
UNION ALL SELECT 'without a file', 0""")
def inc4_ingest_rejects(spark, sf_dir):
    """What the same ingest rejected, by reason, beside the rows its batches counted and the rejects that name no file."""
    table = ingested_lines(spark, sf_dir)
    rejects = spark.read.parquet(f"{table}/rejects")
    counted = spark.read.parquet(f"{table}/counters").agg(F.sum("rows").alias("n")).select(F.lit("counted").alias("reason"), "n")
    nameless = rejects.filter(~F.col("file").contains("/lines/")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("without a file").alias("reason"), "n")
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(counted).unionByName(nameless)


@register("inc5_merged_table", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + "SELECT arg1, rel, arg2, n_instances, n_urls, max_conf, min_conf FROM grp")
def inc5_merged_table(spark, sf_dir):
    """Four batches (the last one repeats a part of the first) appended as deltas; homes are compacted and split on the way."""
    from factweave.streaming.ingest import upsert_batch
    from factweave.streaming.table import table_summary
    rows = cut_lineage(scored_extractions(spark, sf_dir).select(*G.KEY, *G.INSTANCE))
    digit, table = F.substring(F.md5("url"), 1, 1), scratch_path(spark, "group-table")
    for i, part in enumerate((digit < "6", (digit >= "6") & (digit < "b"), digit >= "b", digit < "2")):
        upsert_batch(spark, rows.filter(part), i, table, buckets=4, home_bytes=1 << 18)
    drop_stored(rows)
    return table_summary(spark, table)


@register("src2_write_lines", REC_SQL + "SELECT value, count(*) AS n FROM rec_lines GROUP BY value")
def src2_write_lines(spark, sf_dir):
    """Record lines written as text files and read back."""
    path = scratch_path(spark, "lines")
    record_lines(spark, sf_dir).select("value").write.text(path)
    return spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@register("src15_old_layout", S.with_(S.text_ctes(), S.annotate_cte()) + f"""
SELECT 'http://' || split_part(t.url, '/', 1) || '/' || split_part(t.url, '/', 2) AS url,
       {', '.join('t.' + c for c in SPAN_COLS)},
       array_to_string(t.tokens, ' ') AS tokens, array_to_string(a.ptags, ' ') AS postags,
       array_to_string(a.chunks, ' ') AS chunks
FROM tex_raw t JOIN ann a ON t.doc_id = a.doc_id AND t.sid = a.sid
WHERE (t.arg1_start + t.rel_len) % 11 <> 0 AND (t.arg1_start + t.rel_len) % 13 <> 0""")
def src15_old_layout(spark, sf_dir):
    out = read_old_layout(old_layout_lines(spark, sf_dir))
    return out.select("url", *SPAN_COLS, F.array_join("tokens", " ").alias("tokens"),
                      F.array_join("postags", " ").alias("postags"), F.array_join("chunks", " ").alias("chunks"))


@register("inc3_singleton_groups", S.with_(S.EXTRACTIONS) + """
SELECT arg1, rel, arg2, inst_id, confidence, CAST(1 AS BIGINT) AS n_instances FROM ex_i""")
def inc3_singleton_groups(spark, sf_dir):
    from factweave.streaming.upsert import singleton_groups
    inst, parts = singleton_groups(scored_extractions(spark, sf_dir).select(*G.KEY, *G.INSTANCE), batch=1)
    return inst.select(*G.KEY, "inst_id", "confidence", F.lit(1).cast("long").alias("n_instances"))


@register("pf1_inlink_ratio_arg2", LINKED_SQL + """
SELECT CASE WHEN inl = 0 THEN CAST('inf' AS DOUBLE)
            ELSE CAST(CAST(floor((20000 * n + inl) / (2 * inl)) AS BIGINT) AS DOUBLE) / CAST(10000.0 AS DOUBLE) END AS ratio,
       name, fbid, n AS n_groups, inl AS inlinks
FROM (SELECT arg2_fbid AS fbid, count(*) AS n,
             arg_min(arg2_name, arg1 || chr(9) || rel || chr(9) || arg2) AS name,
             CAST(arg_min(arg2_inlinks, arg1 || chr(9) || rel || chr(9) || arg2) AS BIGINT) AS inl
      FROM lg WHERE arg2_fbid IS NOT NULL GROUP BY arg2_fbid)""")
def pf1_inlink_ratio_arg2(spark, sf_dir):
    """Role selection: the inlink job on the arg2 role (any value but 'arg1' selects arg2)."""
    return G.inlink_ratio(linked(spark, sf_dir, [f"arg2_{c}" for c in ("fbid", "name", "inlinks")]), "anything-else")


@register("tx5_rekey_groups", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS) + """
SELECT """ + S.row_hash("arg1", "rel", "arg2") + """ AS gid, arg1, rel, arg2 FROM grp""")
def tx5_rekey_groups(spark, sf_dir):
    """Stored groups (gid = their stored key) re-keyed from their first instance."""
    inst = grouped(spark, sf_dir).withColumn("gid", G.row_hash(*G.KEY))
    return G.rekey_groups(inst)


@register("inc2_relink_groups", S.with_(S.EXTRACTIONS, S.INSTANCES, S.GROUPS, S.LINKED, S.BATCHED, S.LINK_TABLES,
                                        S.FIRST_INST, S.LINK_BEST) + """,
keys AS (SELECT arg1, rel, arg2, max(CASE WHEN batch = 12 THEN 1 ELSE 0 END) = 1 AS in_incoming
         FROM exb GROUP BY arg1, rel, arg2),
flags AS (SELECT g.arg1, g.rel, g.arg2, k.in_incoming AS relink
          FROM grp g JOIN keys k ON g.arg1 = k.arg1 AND g.rel = k.rel AND g.arg2 = k.arg2)
SELECT f.arg1, f.rel, f.arg2, f.relink AS relinked,
       CASE WHEN f.relink THEN l.arg1_fbid ELSE struct_extract(h.e, 'arg1_fbid') END AS arg1_fbid,
       CASE WHEN f.relink THEN l.arg2_fbid ELSE struct_extract(h.e, 'arg2_fbid') END AS arg2_fbid
FROM flags f
JOIN head h ON f.arg1 = h.arg1 AND f.rel = h.rel AND f.arg2 = h.arg2
JOIN linked l ON f.arg1 = l.arg1 AND f.rel = l.rel AND f.arg2 = l.arg2""")
def inc2_relink_groups(spark, sf_dir):
    from factweave.streaming.upsert import merge_batch, relink_groups
    inst, parts, rows = stored_batches(spark, sf_dir)
    merged, head, flags = merge_batch((inst.filter("batch < 12"), parts.filter("batch < 12")),
                                      (inst.filter("batch = 12"), parts.filter("batch = 12")), incoming_batch=12, store=True,
                                      columns=["tokens", *G.SPANS], spent=(rows,))
    drop_stored(parts)
    anchors, ents = map(cut_lineage, FX.link_tables(spark, sf_dir))  # a knowledge base is stored tables
    out = relink_groups(merged, head, flags, anchors, ents)
    return out.select(*G.KEY, "relinked", "arg1_fbid", "arg2_fbid")
