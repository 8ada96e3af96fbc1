"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints: words of the ASCII-lower-cased text, word shingles (repeats included), XXH64 with seed
42 of each; a bit is set where more than half of the shingles have it set.

Covering masks: bit i of a fingerprint gets a non-zero vector m(i) of F2^(r+1), r the radius; table v
(every non-zero v) keeps the bits with <m(i), v> = 1. The at most r differing bits of a pair span at most
r dimensions, so some v is orthogonal to all of them, and the pair collides in table v: no pair within
the radius is missed (2^(r+1) - 1 tables, 31 for radius 4; each keeps about half of the bits).

Copies first: equal fingerprints become one representative. Only representatives are hashed into the
tables. Inside a bucket a search from fingerprint to fingerprint compares each with those not yet
reached and emits a spanning forest, so a bucket of m gives fewer than m links, never all pairs. A
bucket of over ``BLOCK`` fingerprints is dealt into blocks, and each two blocks meet in a task of
their own; the table of such buckets is written first, so that the planner knows its size. Components
follow from the forest by distributed star contraction in the shared folder.

Defined results: null and empty texts have fingerprint zero and link like any other; repeated ids are
one document if their texts give the same fingerprint, else the id carries each of its fingerprints
and ties their groups; null ids are kept, never linked, and are their own (null) component; an empty
table gives an empty result; other columns are not read (``near_dedup`` returns them unchanged).
``near_dedup`` does not tie the groups of an id's fingerprints: it keeps one row per group of texts.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import byte_chunks, components, map_text, ship, stored

BLOCK = 4096       # fingerprints that meet in one comparison block
SEED = 42


def fingerprint(raw: bytes, shingle: int) -> int:
    words = raw.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    text = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(text, SEED)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(text[a:b], SEED) for a, b in zip(start[:n].tolist(), end[shingle - 1:].tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    def run(batches):
        for rows, texts in byte_chunks(batches, "text"):
            yield rows.column(0), pa.array(np.array([fingerprint(t, shingle) for t in texts], "<u8").view("<i8"))

    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, fp long")


def masks(radius: int, bits: int = 64) -> list[int]:
    """The kept bits of each table as an integer; m(i) runs through the non-zero vectors evenly, in a fixed shuffled order."""
    vectors = list(range(1, 2 ** (radius + 1)))
    assigned = (vectors * (bits // len(vectors) + 1))[:bits]
    random.Random(20).shuffle(assigned)
    return [sum(1 << i for i, m in enumerate(assigned) if bin(m & v).count("1") % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bucketed(reps: DataFrame, radius: int) -> DataFrame:
    """(t, k, fp): every representative in every table; k is its fingerprint under the table's mask."""
    table = F.posexplode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks(radius)])).alias("t", "mask")
    return reps.select("fp", table).select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp")


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest (member, root) of the graph of pairs within ``radius`` over distinct fingerprints."""
    rest, links = values, []
    while len(rest):
        root, rest = rest[0], rest[1:]
        frontier = [root]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                frontier.extend(found)
                links += [(int(f), int(root)) for f in found]
    return links


def links(reps: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """(a, b): fingerprints tied by some bucket's spanning forest; every pair within the radius is connected through them."""
    ship(reps.sparkSession)
    rows = bucketed(reps, radius)
    sizes = rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    sizes = stored(sizes.select("t", "k", F.ceil(F.col("n") / block).cast("int").alias("blocks")).filter("blocks > 1"))
    dealt = rows.join(sizes, ["t", "k"], "left")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    # block i meets every block j in the tile (min, max); an ordinary bucket is the one tile (0, 0)
    tiles = dealt.select("t", "k", "fp", "blocks", mine.alias("i"), F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
                         .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("j")) \
        .select("t", "k", "fp", F.coalesce(F.least("i", "j"), F.lit(0)).alias("i"), F.coalesce(F.greatest("i", "j"), F.lit(0)).alias("j"))
    grouped = tiles.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")

    def run(batches):
        carry = None  # rows of the group that is still open: at most two blocks

        def closed(rows, last):
            """Links of the groups in the sorted ``rows``; without ``last`` the final group stays open and is returned."""
            cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(rows)]])
            keep = None if last else rows[starts[-1]:].copy()
            full = len(starts) if last else len(starts) - 1
            found = [x for i in np.flatnonzero(ends[:full] - starts[:full] > 1)
                     for x in forest(rows[starts[i]:ends[i], 4].copy().view(np.uint64), radius)]
            return found, keep

        def batch_of(found):
            x = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("t", "k", "i", "j", "fp")], axis=1)
            if len(rows):
                found, carry = closed(rows if carry is None else np.concatenate([carry, rows]), False)
                yield batch_of(found)
        if carry is not None:
            yield batch_of(closed(carry, True)[0])

    return grouped.mapInArrow(run, "a long, b long").distinct()


def simhash_components(docs: DataFrame, shingle: int = 4, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    marked = stored(fingerprints(docs, shingle))
    reps = stored(marked.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("least")))
    near = stored(links(reps.select("fp"), radius, block))
    named = reps.select(F.col("fp").alias("a"), F.col("least").alias("x"))
    edges = near.join(named, "a").select("x", "b").join(named.withColumnRenamed("x", "y").withColumnRenamed("a", "b"), "b") \
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    # one vertex per representative, named by its smallest document; an id with several fingerprints ties them
    repeated = marked.groupBy("doc_id").agg(F.min("fp").alias("f0"), F.max("fp").alias("f1")).filter("f0 <> f1").select("doc_id")
    tied = marked.join(repeated, "doc_id").join(reps, "fp").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    comp = components(reps.select(F.col("least").alias("id")).distinct(), edges.unionByName(tied))
    of_fp = reps.join(comp.withColumnRenamed("id", "least"), "least").select("fp", "component_id")
    return marked.join(of_fp, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def survivors(marked: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """(doc_id, fp): of each component of fingerprints the document that stays, by its least id, then its least fingerprint."""
    reps = stored(marked.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = components(reps.select(F.col("fp").alias("id")), links(reps.select("fp"), radius, block))
    return comp.join(reps, F.col("id") == F.col("fp")).groupBy("component_id") \
        .agg(F.min(F.struct("least", "fp")).alias("stays")).select(F.col("stays.least").alias("doc_id"), F.col("stays.fp").alias("fp"))


def near_dedup(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component of fingerprints, and all rows with a null id.

    Components tie fingerprints, not ids: an id with unlike texts stands in the component of each of them.
    Ids of one row are decided by id alone. Rows of an id that occurs more often are fingerprinted again, and
    of those with the surviving (id, fingerprint) the one of least hash is taken.
    """
    marked = stored(fingerprints(docs, shingle))
    stay = stored(survivors(marked, radius))
    ids = stored(marked.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")))
    often = stored(ids.filter("n > 1").select("doc_id"))
    gone = stored(ids.filter("n = 1").join(stay, "doc_id", "left_anti").select("doc_id").unionByName(often))
    single = docs.join(gone, "doc_id", "left_anti")
    stay = stored(stay.join(often, "doc_id", "left_semi"))
    columns = docs.columns
    names = [f"c{i}" for i in range(len(columns))]  # names of the input cannot clash with those added here
    at = dict(zip(columns, names))
    rows = docs.toDF(*names)
    rows = rows.join(stay.select(F.col("doc_id").alias(at["doc_id"])).distinct(), at["doc_id"], "left_semi").select(*names)
    rows = rows.withColumn("text", F.col(at["text"]).cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema.fields) + ", fp long"

    def run(batches):
        for part, texts in byte_chunks(batches, "text"):
            yield [part.column(i) for i in range(len(names))] + [pa.array(np.array([fingerprint(t, shingle) for t in texts], "<u8").view("<i8"))]

    rows = map_text(rows, run, schema).join(stay.select(F.col("doc_id").alias(at["doc_id"]), "fp"), [at["doc_id"], "fp"], "left_semi")
    one = rows.groupBy(at["doc_id"], "fp").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row"))
    return single.select(*columns).unionByName(one.select(*[F.col(f"row.{n}").alias(c) for c, n in at.items()]))
