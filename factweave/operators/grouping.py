"""Grouping of extractions into (arg1, rel, arg2) facts and the aggregations over groups.

Internal form (SURVEY §4.3): flat instance rows carrying their group key; the nested
ExtractionGroup is produced only on output (``nest_groups``). All aggregations are partial
(map-side) first and nothing is capped unless the caller asks for it (AG2), so one key holding
a third of the rows never lands whole in one task and loses no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave import constants as C
from factweave.functions import clean_control, span_text
from factweave.operators.caps import FEW, cap_per_key, first_few_per_key
from factweave.session import cut_lineage, drop_stored

KEY = ["arg1", "rel", "arg2"]
SPANS = ["arg1_start", "arg1_len", "rel_start", "rel_len", "arg2_start", "arg2_len"]
INSTANCE = ["tokens", *SPANS, "url", "corpus", "confidence"]
PARTS = [f"{r}_{c}" for r in ("arg1", "arg2") for c in ("fbid", "name", "inlinks", "types")]


def prefixed(c) -> Column:
    """A value with its length in front, ``~`` for NULL: joined values cannot run into each other."""
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.length(s), F.lit(":"), s), F.lit("~"))


def row_hash(*cols) -> Column:
    """md5 over length-prefixed values: equal hash <=> equal values, NULLs included."""
    return F.md5(F.concat_ws("|", *[prefixed(c) for c in cols]))


def instance_hash() -> Column:
    """md5 over every instance field: equal hash <=> equal instance (ties interchangeable)."""
    tokens = F.array_join(F.transform("tokens", prefixed), ",")
    return row_hash(tokens, *SPANS, "url", "corpus", F.col("confidence").cast("decimal(9,6)"))


def instance_identity() -> Column:
    """16 bytes that are equal exactly where ``instance_hash`` is, formed without a look at single tokens: for counting
    distinct instances, not for ids that are kept or ordered.

    Tokens are joined by a control character; where the text itself has one of the two that mark ends and NULLs, the
    length-prefixed form of ``instance_hash`` stands instead.
    """
    end, null = "\x01", "\x02"
    text = F.array_join("tokens", "")
    marked = F.contains(text, F.lit(end)) | F.contains(text, F.lit(null))
    tokens = F.when(marked, F.concat(F.lit("p"), F.array_join(F.transform("tokens", prefixed), ","))) \
        .otherwise(F.concat(F.lit("j"), F.array_join("tokens", end, null)))
    numbers = [F.coalesce(c.cast("string"), F.lit("~")) for c in (F.array_size("tokens"), *map(F.col, SPANS), F.col("confidence").cast("decimal(9,6)"))]
    return F.unhex(F.md5(F.concat_ws("|", *numbers, prefixed("url"), prefixed("corpus"), F.coalesce(tokens, F.lit("")))))


def one_per(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """One row per ``by`` with ``columns`` of one of its rows. They pass the shuffle as one value: one by one, each would bring a
    flag that tells whether it is set."""
    columns = [c for c in columns if c not in by]
    if not columns:
        return rows.select(*by).distinct()
    return rows.groupBy(*by).agg(F.first(F.struct(*columns)).alias("_r")).select(*by, "_r.*")


def group_instances(extractions: DataFrame, max_group_size: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """AG1 + ST3: the distinct instances of every key; with ``max_group_size`` (AG2) of at most so
    many raw rows per key, in md5 order.

    Input: flat extractions with KEY and INSTANCE columns. Output: one row per distinct
    (key, instance) with ``inst_id`` (the instance hash, taken from the input if it has it) and, of INSTANCE, ``columns``
    where the caller reads no others. Dedup groups by (key, inst_id), so a hot key is spread over all shuffle partitions.
    A large cap reads its rows several times, so they are stored once; a small one takes them in one shuffle, which the dedup shares,
    and its result is stored.
    """
    x = extractions if "inst_id" in extractions.columns else extractions.withColumn("inst_id", instance_hash())
    x = x.select(*KEY, *(INSTANCE if columns is None else columns), "inst_id")
    if max_group_size is not None and 1 <= max_group_size <= FEW:
        few = first_few_per_key(x, KEY, "inst_id", max_group_size)
        return cut_lineage(one_per(few, [*KEY, "inst_id"], x.columns).select(x.columns))
    if max_group_size is not None:
        x = cap_per_key(cut_lineage(x), KEY, "inst_id", max_group_size)
    return one_per(x, [*KEY, "inst_id"], x.columns).select(x.columns)


def group_summary(instances: DataFrame) -> DataFrame:
    """Flat per-group summary: instance count, distinct sources, confidence range."""
    return instances.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_instances"),
        F.countDistinct("url").alias("n_urls"),
        F.max("confidence").alias("max_conf"),
        F.min("confidence").alias("min_conf"),
    )


def summarize(extractions: DataFrame) -> DataFrame:
    """``group_summary`` of raw extractions without forming instances: only the key, the url, the
    confidence and the instance hash reach the shuffle."""
    # rows of one instance meet first (they share the url, which the hash covers), as 16 bytes instead of 32 hex digits
    narrow = extractions.select(*KEY, "url", "confidence", instance_identity().alias("inst_id"))
    one = narrow.groupBy(*KEY, "inst_id").agg(F.first("url").alias("url"), F.max("confidence").alias("max_conf"), F.min("confidence").alias("min_conf"))
    return one.groupBy(*KEY).agg(
        F.count("inst_id").alias("n_instances"),
        F.countDistinct("url").alias("n_urls"),
        F.max("max_conf").alias("max_conf"),
        F.min("min_conf").alias("min_conf"))


def frequency_filter(groups: DataFrame, min_freq: int = 0, max_freq: int = 2**31 - 1,
                     size_col: str = "n_instances") -> DataFrame:
    """PF6: keep a group iff min_freq <= size <= max_freq (inclusive)."""
    return groups.filter(F.col(size_col).between(min_freq, max_freq))


def nest_groups(instances: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Nested ExtractionGroup rows (output form). Instances sorted for determinism.

    ``parts`` may supply per-key entity/types columns (arg1_entity, arg1_types, ...);
    otherwise groups carry no entity and no types, as freshly grouped ones do.
    """
    inst = F.struct(
        F.struct(F.transform("tokens", lambda t: F.struct(t.alias("string"))).alias("tokens"),
                 *[F.struct(F.col(f"{p}_start").alias("start"), F.col(f"{p}_len").alias("length")).alias(p)
                   for p in ("arg1", "rel", "arg2")],
                 F.col("url")).alias("extraction"),
        F.col("corpus"), F.col("confidence"), F.col("inst_id"))
    g = instances.groupBy(*KEY).agg(F.array_sort(F.collect_list(inst)).alias("instances"))
    if parts is not None:
        g = g.join(parts, KEY, "left")
    else:
        ent = F.lit(None).cast("struct<name:string,fbid:string,score:double,inlinks:bigint>")
        g = g.withColumn("arg1_entity", ent).withColumn("arg2_entity", ent) \
             .withColumn("arg1_types", F.array().cast("array<string>")) \
             .withColumn("arg2_types", F.array().cast("array<string>"))
    return g.select(
        F.struct(F.col("arg1").alias("norm"), F.col("arg1_entity").alias("entity"), F.col("arg1_types").alias("types")).alias("arg1"),
        F.struct(F.col("rel").alias("norm")).alias("rel"),
        F.struct(F.col("arg2").alias("norm"), F.col("arg2_entity").alias("entity"), F.col("arg2_types").alias("types")).alias("arg2"),
        "instances")


def arg_pairs(groups: DataFrame) -> DataFrame:
    """AG4: per relation, the ``arg1+arg2`` pairs of its groups (not deduplicated), in long form: no row
    ever holds a whole relation."""
    return groups.select("rel", F.concat_ws("+", "arg1", "arg2").alias("pair"))


def inlink_ratio(groups: DataFrame, role: str = "arg1") -> DataFrame:
    """AG5: per linked fbid of ``role``: groups / inlinks to 4 dp (half-up), name and fbid.

    Unlinked groups are filtered before the shuffle (Q12). Name and inlinks come from the
    member with the smallest group key (the original takes an arbitrary one). Zero inlinks
    give +Infinity, as the original's double division does.
    """
    if role not in ("arg1", "arg2"):
        role = "arg2"  # the original treats any other value as arg2
    g = groups.filter(F.col(f"{role}_fbid").isNotNull()).select(
        F.col(f"{role}_fbid").alias("fbid"),
        F.struct(F.col(f"{role}_name").alias("name"), F.col(f"{role}_inlinks").alias("inlinks")).alias("e"),
        F.concat_ws("\t", *KEY).alias("k"))
    a = g.groupBy("fbid").agg(F.count(F.lit(1)).alias("n_groups"), F.min_by("e", "k").alias("e"))
    n, il = F.col("n_groups").cast("long"), F.col("e.inlinks").cast("long")
    ratio = F.when(il == 0, F.lit(float("inf"))).otherwise(
        F.floor((F.lit(20000) * n + il) / (F.lit(2) * il)).cast("long").cast("double") / 10000.0)
    return a.select(ratio.alias("ratio"), F.col("e.name").alias("name"), "fbid", "n_groups",
                    F.col("e.inlinks").cast("long").alias("inlinks"))


def answer_keys(groups: DataFrame, expand: bool = False) -> DataFrame:
    """PF11: wildcard answer keys. The original builds the six blanked variants and then
    emits the group unchanged; ``expand=True`` returns the variants (GROUPING SETS over
    the six one- or two-field subsets plus the identity) with their group counts."""
    if not expand:
        return groups
    g = groups.select(*KEY)
    return g.groupingSets([[*KEY], ["rel", "arg2"], ["arg1", "arg2"], ["arg1", "rel"], ["arg1"], ["rel"], ["arg2"]],
                          *KEY).agg(F.count(F.lit(1)).alias("n_groups")) \
        .select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in KEY], "n_groups")


def first_instance_parts(rows: DataFrame, by: list[str], fields: tuple[str, ...] = ("fbid", "name", "inlinks", "types")) -> DataFrame:
    """Entity parts of a group taken from its first instance (smallest inst_id, then fbids); only ``fields`` of them where the
    caller reads no others (a minimum over whole parts carries them all through its shuffle). ``inst_id`` may be hex text or its bytes."""
    fbids = [F.coalesce("arg1_fbid", F.lit("")), F.coalesce("arg2_fbid", F.lit(""))]
    order = F.struct("inst_id", F.concat_ws("|", *fbids)) if dict(rows.dtypes)["inst_id"] == "binary" else F.concat_ws("|", "inst_id", *fbids)
    e = F.struct(*[F.col(f"{r}_{c}") for r in ("arg1", "arg2") for c in fields])
    return rows.groupBy(*by).agg(F.min_by(e, order).alias("e")).select(*by, "e.*")


def linked_groups(rows: DataFrame, parts: list[str] = PARTS) -> DataFrame:
    """Flat linked groups: key, size, and the entity parts of each group's first instance (only ``parts`` of them where the
    caller reads no others).

    One pass over ``rows`` (with ``inst_id``): rows of one instance meet first, then the instances of a group.
    """
    order = F.struct(F.coalesce("arg1_fbid", F.lit("")), F.coalesce("arg2_fbid", F.lit("")))
    one = rows.groupBy(*KEY, "inst_id").agg(F.first("url").alias("url"), F.first("confidence").alias("confidence"),
                                            F.min_by(F.struct(*parts), order).alias("e"))
    return one.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_instances"), F.countDistinct("url").alias("n_urls"),
        F.max("confidence").alias("max_conf"), F.min("confidence").alias("min_conf"),
        F.min_by("e", "inst_id").alias("e")).select(*KEY, "n_instances", "n_urls", "max_conf", "min_conf", "e.*")


def clean_instances(inst: DataFrame) -> DataFrame:
    """PF7 on every token string and on the norms (tab -> space, drop \\p{C})."""
    out = inst.withColumn("tokens", F.transform("tokens", clean_control))
    for k in KEY:
        if k in out.columns:
            out = out.withColumn(k, clean_control(k))
    return out


def rekey_groups(instances: DataFrame) -> DataFrame:
    """TX5: the normalised key of every group (``gid``) recomputed from its first instance. Instances without ``tokens`` carry
    their own normalised key already."""
    from factweave.sources.fixtures import with_norms
    own = with_norms(instances.select("gid", "inst_id", "tokens", *SPANS)) if "tokens" in instances.columns else instances
    return own.groupBy("gid").agg(F.min_by(F.struct(*KEY), "inst_id").alias("k")).select("gid", "k.*")


def key_extents(instances: DataFrame, parts: DataFrame) -> DataFrame:
    """Per group (``gid``) the least key of its instances, whether they have several (``mixed``), and of its ``parts`` (rows of
    gid, ``o``, their order, ``e`` and ``batch``) the first ``e``, ``first_batch`` and ``last_batch``: one shuffle for both."""
    both = instances.select("gid", F.struct(*KEY).alias("k")).unionByName(parts, allowMissingColumns=True)
    g = both.groupBy("gid").agg(F.min("k").alias("k"), F.max("k").alias("hi"), F.min_by("e", "o").alias("e"),
                                F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch"))
    return g.filter(F.col("k").isNotNull()).select("gid", "k", (~F.col("k").eqNullSafe(F.col("hi"))).alias("mixed"), "e", "first_batch", "last_batch")


def regroup(instances: DataFrame, parts: DataFrame, columns: list[str] | None = None, spent: tuple[DataFrame, ...] = ()):
    """AG3 + TX5 + ST1: merge groups whose (re-computed) keys are equal.

    ``instances``: one row per (gid, instance) of every input group, with ``batch`` (input
    order of the group) and INSTANCE columns (confidence NULL or < 0 = unscored).
    ``parts``: one row per input group: gid, batch, arg1_fbid, ..., arg2_types.

    Steps: clean control characters (PF7), score unscored instances (TX3), key every group
    by the normalised key of its first instance (TX4/TX5), union the instance sets (whole,
    deduplicated) and take the arg/rel parts from the first group (lowest batch, then gid) having
    an entity on either side, else from the first group. Returns (instances, head parts).

    The instances returned hold ``columns`` where the caller reads no others. Every step's rows are stored, and what it
    has read goes: the stored frames ``spent``, which nothing but ``instances`` reads, once these have been read, and the shuffles
    of a step with it. Each instance carries its own key, so only those of groups with several keys meet the key of their group.
    """
    from factweave.operators.score import score
    from factweave.sources.fixtures import with_norms
    columns = INSTANCE if columns is None else columns
    # ids travel as 16 bytes: the group's id (the md5 of one that is text), and the instance hash without its hex form
    g16 = F.col("gid") if dict(instances.dtypes)["gid"] == "binary" else F.unhex(F.md5("gid"))
    inst = score(clean_instances(instances), only_unscored=True).withColumn("inst_id", F.unhex(instance_hash()))
    # an instance that is not the first of its group may have spans that no slice takes: it has no key of its own
    valid = F.least(*SPANS) >= 0
    inst = with_norms(inst.withColumns({f"_{c}": F.col(c) for c in SPANS} | {c: F.when(valid, F.col(c)) for c in SPANS})) \
        .withColumn("gid", g16).filter(F.col("gid").isNotNull()) \
        .select("gid", *KEY, *[F.col(f"_{c}").alias(c) if c in SPANS else c for c in columns], "inst_id")
    inst = cut_lineage(inst)  # read for the keys and for the union
    drop_stored(*spent)
    cols = [c for c in parts.columns if c not in (*KEY, "batch", "gid")]
    unlinked = (F.col("arg1_fbid").isNull() & F.col("arg2_fbid").isNull()).cast("int")
    o = F.struct(unlinked.alias("u"), "batch", *([] if dict(parts.dtypes)["gid"] == "binary" else ["gid"]))
    p = parts.select(g16.alias("gid"), o.alias("o"), F.struct(o.alias("o"), *cols).alias("e"), "batch").filter(F.col("gid").isNotNull())
    keyed = cut_lineage(key_extents(inst, p))
    mixed = cut_lineage(keyed.filter("mixed").select("gid"))
    first = cut_lineage(rekey_groups(inst.select("gid", *KEY, "inst_id").join(mixed, "gid", "left_semi")).select("gid", F.struct(*KEY).alias("_k")))

    def with_group_key(rows: DataFrame, own) -> DataFrame:
        return rows.join(first, "gid", "left").withColumn("_k", F.when(F.col("_k").isNull(), own).otherwise(F.col("_k")))

    head = with_group_key(keyed.filter(F.col("e").isNotNull()), F.col("k")).select("_k.*", "gid", "e", "first_batch", "last_batch").groupBy(*KEY).agg(
        F.min_by("e", F.struct("e.o", "gid")).alias("h"), F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch"))
    head = cut_lineage(head.select(*KEY, *[f"h.{c}" for c in cols], "first_batch", "last_batch"))
    drop_stored(keyed, mixed)
    out = with_group_key(inst, F.struct(*KEY)).select("_k.*", *columns, "inst_id")
    return one_per(out, [*KEY, "inst_id"], columns).select(*KEY, *columns, F.lower(F.hex("inst_id")).alias("inst_id")), head


def relink_flag(size) -> Column:
    """The original's rule for re-linking: only if size > 1 and (size < 5 or size even). An explicit option."""
    n = F.col(size) if isinstance(size, str) else size
    return (n > C.RELINK_MIN_EXCLUSIVE) & ((n < C.RELINK_SMALL_EXCLUSIVE) | (n % 2 == 0))


def render_groups(instances: DataFrame, parts: DataFrame) -> DataFrame:
    """PF10: arg1, rel, arg2 (token strings of the first instance), (name,fbid) or 'none' x2,
    then one column per distinct source sentence - as one tab-joined line."""
    txt = [F.when(F.least(*SPANS) >= 0, span_text("tokens", f"{p}_start", f"{p}_len")).alias(p) for p in ("arg1", "rel", "arg2")]
    first = instances.groupBy(*KEY).agg(
        F.min_by(F.struct(*txt), "inst_id").alias("f"),
        F.array_sort(F.collect_set(F.array_join("tokens", " "))).alias("sentences"))
    ent = [F.when(F.col(f"{r}_fbid").isNull(), F.lit("none"))
           .otherwise(F.concat(F.lit("("), F.col(f"{r}_name"), F.lit(","), F.col(f"{r}_fbid"), F.lit(")")))
           for r in ("arg1", "arg2")]
    j = first.join(parts, KEY, "inner")
    return j.select(*KEY, F.concat_ws("\t", *[f"f.{p}" for p in ("arg1", "rel", "arg2")], *ent, F.array_join("sentences", "\t")).alias("line"))


RENDER_HEADER = "\t".join(["arg1", "rel", "arg2", "arg1_entity", "arg2_entity", "sentences..."])
