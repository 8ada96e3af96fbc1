"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (null last) weigh 5, 2, 1 in turn and share 150 % of all words;
a target stops at twice its source's size and the excess is shared anew by weight (water filling,
solved in closed form over the sources sorted by size per weight).

Rates: among all document rates that meet a source's word target, none above ``MOST``, the one nearest
to "once each" in relative entropy is r = min(MOST, exp(lambda * size / scale)): an exponential tilt by
size. Newton steps on the convex dual find lambda for all sources at once. The rate depends on source
and size only, so a step reads the (source, size) histogram, not the documents: one aggregation with
a partial sum, joined to the table of multipliers. Sums are taken over integers, so the order of rows
cannot change a digit and reruns agree. The driver sees one number per step, the largest error.

Copies: rows alike in source, id and size are one group of n and get floor(n * r + u) copies together, u a
hash of id and size, in expectation n * r. What the sum then misses is settled per source by the groups
nearest to the next rounding step: a histogram over 2^16 priority buckets gives the bucket where the gap
closes, groups before it change by one copy, and only those of that bucket are ranked. The last one may
be taken in part (its first words), so a source meets its target to a word. A group's copies are dealt to
its rows, the quotient to all and the remainder by a stable ordinal: its place among the group's rows of
its stored partition, after those of the partitions before, so no task sees more of a group than one partition holds.

Documents meet per-source values in a join with one row per source, which the planner broadcasts when
its stored size allows and splits by adaptive execution otherwise; a hot source is never one task's.

Defined results: null text has size 0 and is taken 0 times, like an empty one; a null source is a
source of its own; repeated rows (same id, source and size, null ids too) share their group's copies and
differ by one copy at most; an empty table gives an empty result; other columns are not read (``mix``
returns them with each copy). ``mix(whole_texts=True)`` rounds the part to a whole copy or none.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm.common import byte_chunks, map_text, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5         # of all words
MOST = 2            # times a document may be taken
BUCKETS = 1 << 16
STEPS, CLOSE = 80, 1e-7
_UNIT = 1024.0      # sums count 1/1024 words as integers


def sized(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` plus ``size``, the number of words of ``text``."""
    rows = docs.select(*keep, *([] if text in keep else [text]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields) + ", size long"

    def run(batches):
        for part, texts in byte_chunks(batches, text):
            yield [part.column(i) for i in range(len(keep))] + [pa.array([len(t.split()) for t in texts], pa.int64())]

    return map_text(rows, run, schema)


def source_key(source: Column) -> Column:
    """A join key that is never null and sorts as sources do, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def targets(sizes: DataFrame) -> DataFrame:
    """(key, source_size, target): one row per source. The windows run over sources, not over documents."""
    s = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy("key")) - 1
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")).cast("double"))
    s = s.withColumn("cap", F.lit(float(MOST)) * F.col("source_size"))
    everyone = Window.partitionBy()
    s = s.withColumn("words", SHARE * F.sum("source_size").over(everyone)).withColumn("weights", F.sum("w").over(everyone))
    before = Window.orderBy(F.col("cap") / F.col("w"), "key").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("words") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("capped", level * F.col("w") >= F.col("cap"))
    rest = F.col("words") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everyone), F.lit(0.0))
    free = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everyone)
    return s.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(rest * F.col("w") / free)).select("key", "source_size", "target")


def rate() -> Column:
    """Rate of a document from its size and its source's multiplier; null multiplier: the bound itself."""
    return F.coalesce(F.least(F.lit(float(MOST)), F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("scale"), F.lit(5.0)))), F.lit(float(MOST)))


def multipliers(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """(key, source_size, target, scale, multiplier): Newton iterations on the dual, all sources at once."""
    hist = stored(sizes.filter("size > 0").groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")))
    stats = hist.groupBy("key").agg((F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("scale"), F.min("size").alias("least"))
    p = goal.join(stats, "key", "left")
    ratio = F.try_divide("target", "source_size")
    z = F.try_divide(F.col("least").cast("double"), "scale")
    bound = ratio >= MOST - 1e-12
    start = F.log(ratio)
    p = stored(p.select("key", "source_size", "target", "scale",
                        F.when(bound | F.col("scale").isNull(), None).otherwise(start).alias("multiplier"),
                        F.when(ratio >= 1, F.lit(0.0)).otherwise(F.try_divide(F.log(ratio), z)).alias("lo"),
                        F.when(ratio <= 1, F.lit(0.0)).otherwise(F.try_divide(F.log(F.lit(float(MOST))), z)).alias("hi")))
    whole = lambda x: F.sum(F.round(x * _UNIT).cast("long")) / _UNIT
    for _ in range(STEPS):
        r = rate()
        words = F.col("n") * F.col("size") * r
        slope = F.when(r < MOST, words * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = hist.join(p.filter("multiplier IS NOT NULL").select("key", "multiplier", "scale"), "key") \
            .groupBy("key").agg(whole(words).alias("got"), whole(slope).alias("slope"))
        now = stored(p.join(sums, "key", "left"))
        gap = now.agg(F.max(F.abs(F.col("got") - F.col("target")) / F.greatest("target", F.lit(1.0)))).first()[0]
        if gap is None or gap < CLOSE:
            break
        over = F.col("got") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("multiplier")), F.when(over, F.col("multiplier")).otherwise(F.col("hi"))
        step = F.col("multiplier") - (F.col("got") - F.col("target")) / F.col("slope")
        step = F.when((F.col("slope") > 0) & (step > F.col("lo2")) & (step < F.col("hi2")), step).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        p = stored(now.withColumn("lo2", lo).withColumn("hi2", hi)
                   .select("key", "source_size", "target", "scale", F.when(F.col("got").isNotNull(), step).alias("multiplier"),
                           F.col("lo2").alias("lo"), F.col("hi2").alias("hi")))
    return p.select("key", "source_size", "target", "scale", "multiplier")


GROUP = ["key", "doc_id", "size"]


def _rounded(groups: DataFrame) -> DataFrame:
    """Adds ``copies`` (hash-rounded sum of the rates of the group's ``n`` rows) and, per direction, the priority of changing it by one."""
    u = F.pmod(F.xxhash64("doc_id", "size", F.lit(11)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    x = groups.withColumn("x", F.col("n") * rate() + u).withColumn("copies", F.least(F.floor("x"), F.col("n") * MOST).cast("long"))
    return x.withColumn("frac", F.col("x") - F.floor("x"))


def _priority() -> Column:
    """0 is changed first; null cannot change. ``gap`` is what the source misses: positive adds copies."""
    up = F.when(F.col("copies") < F.col("n") * MOST, 1 - F.col("frac"))
    down = F.when(F.col("copies") > 0, F.col("frac"))
    return F.when(F.col("size") > 0, F.when(F.col("gap") > 0, up).when(F.col("gap") < 0, down))


def same_group(names: dict) -> Column:
    return (F.col("key") == F.col(names["key"])) & F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (F.col("size") == F.col(names["size"]))


def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by group; null ids are equal. The columns of ``right`` that name the group are dropped."""
    names = {c: f"of_{c}" for c in GROUP}
    return left.join(right.withColumnsRenamed(names), same_group(names), how).drop(*names.values())


def ordinals(rows: DataFrame, many: DataFrame) -> DataFrame:
    """(rid, n, ordinal) of the rows that belong to a group of several rows; ordinals run from 0 in the order of ``rid``."""
    x = stored(joined(rows.select(*GROUP, "rid"), many, "inner").withColumn("part", F.shiftright("rid", 33)))
    local = F.row_number().over(Window.partitionBy(*GROUP, "part").orderBy("rid"))
    parts = x.groupBy(*GROUP, "part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("before", F.coalesce(before, F.lit(0))).withColumnRenamed("part", "of_part").drop("rows")
    names = {c: f"of_{c}" for c in GROUP}
    x = x.withColumn("local", local).join(parts.withColumnsRenamed(names), same_group(names) & (F.col("part") == F.col("of_part")))
    return x.select("rid", "n", (F.col("before") + F.col("local") - 1).alias("ordinal"))


def plan_mix(sizes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (rid, doc_id, key, size): per-source values (key, ..., gap, cut), the groups of the cut bucket
    (key, doc_id, size, change), and the rows of groups of several (rid, n, ordinal); all are stored."""
    found = multipliers(sizes, stored(targets(sizes)))
    groups = stored(sizes.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")))
    rows = _rounded(groups.join(found, "key"))
    gaps = rows.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    found = stored(found.join(gaps, "key").withColumn("gap", F.floor("target") - F.col("got")))
    rows = _rounded(groups.join(found, "key")).withColumn("priority", _priority()).filter("priority IS NOT NULL") \
        .withColumn("bucket", F.floor(F.col("priority") * BUCKETS))
    hist = rows.groupBy("key", "bucket").agg(F.sum("size").alias("words"), F.max(F.abs("gap")).alias("need"))
    upto = F.sum("words").over(Window.partitionBy("key").orderBy("bucket"))  # at most BUCKETS rows per source
    cut = hist.withColumn("upto", upto).filter(F.col("upto") >= F.col("need")).groupBy("key") \
        .agg(F.min("bucket").alias("cut"), F.min_by(F.col("need") - F.col("upto") + F.col("words"), "bucket").alias("room"))
    found = stored(found.join(cut, "key", "left"))
    edge = rows.join(found.select("key", "cut", "room"), "key").filter(F.col("bucket") == F.col("cut"))
    before = Window.partitionBy("key").orderBy("priority", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    change = F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.coalesce(F.sum("size").over(before), F.lit(0))))
    edge = stored(edge.withColumn("change", change).select(*GROUP, "change"))
    return found, edge, stored(ordinals(sizes, stored(groups.filter("n > 1 AND size > 0"))))


def taken(rows: DataFrame, found: DataFrame, edge: DataFrame, places: DataFrame) -> DataFrame:
    """``rows`` (rid, doc_id, key, size and more) with source_size, target and ``taken``, the words the mix takes."""
    more = rows.columns
    x = joined(rows.join(found, "key"), edge, "left").join(places, "rid", "left") \
        .withColumn("n", F.coalesce("n", F.lit(1))).withColumn("ordinal", F.coalesce("ordinal", F.lit(0)))
    x = _rounded(x).withColumn("priority", _priority())
    before = F.floor(F.col("priority") * BUCKETS) < F.col("cut")
    moved = F.coalesce(F.col("change"), F.when(before, F.col("size")), F.lit(0)) * F.signum(F.col("gap").cast("double")).cast("long")
    x = x.withColumn("words", F.col("copies") * F.col("size") + moved)  # of the whole group: whole copies, then a part of one
    x = x.withColumn("whole", F.expr("words div nullif(size, 0)"))
    own = F.expr("(whole div n + if(ordinal < whole % n, 1, 0)) * size + if(ordinal = whole % n, words % nullif(size, 0), 0)")
    return x.select(*more, "source_size", "target", F.coalesce(own, F.lit(0)).cast("long").alias("taken"))


def mix_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    rows = stored(sized(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("text").cast("string").alias("text")), ["doc_id", "source"])
                  .select("doc_id", "size", source_key(F.col("source")).alias("key"), F.monotonically_increasing_id().alias("rid")))
    return taken(rows, *plan_mix(rows)).select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken")


def mix(docs: DataFrame, whole_texts: bool = False) -> DataFrame:
    """The mix itself: ``docs`` with a row for every copy; a copy taken in part holds its first words.

    With ``whole_texts`` no text is cut: the one copy of a source that would be taken in part is taken whole if at least half of
    it would be, else left out, so a source misses its target by half of that text at most.

    The documents are stored with their size and row id, so that plan and copies see the same rows.
    """
    columns = docs.columns
    names = [f"c{i}" for i in range(len(columns))]  # names of the input cannot clash with those added here
    at = dict(zip(columns, names))
    rows = docs.toDF(*names)
    rows = stored(sized(rows.select(*names, F.col(at["doc_id"]).cast("long").alias("doc_id"), source_key(F.col(at["source"])).alias("key")), [*names, "doc_id", "key"], at["text"])
                  .withColumn("rid", F.monotonically_increasing_id()))
    x = taken(rows, *plan_mix(rows.select("rid", "doc_id", "key", "size"))).filter("taken > 0")
    if whole_texts:
        x = x.withColumn("taken", F.expr("(2 * taken + size) div (2 * size) * size")).filter("taken > 0")
    rest = F.col("taken") % F.col("size")
    copy = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")))
    x = x.select("*", copy.alias("copy")).withColumn("part", F.when((rest > 0) & (F.col("copy") * F.col("size") > F.col("taken")), rest))
    cut = F.col("part").isNotNull()
    words = F.array_join(F.slice(F.regexp_extract_all(at["text"], F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), F.col("part").cast("int")), " ")
    out = {c: F.col(n) for c, n in at.items()}
    out["text"] = F.when(cut, words).otherwise(out["text"])
    if "n_chars" in out:
        out["n_chars"] = F.when(cut, F.length(words).cast(dict(docs.dtypes)["n_chars"])).otherwise(out["n_chars"])
    return x.select(*[c.alias(n) for n, c in out.items()])
