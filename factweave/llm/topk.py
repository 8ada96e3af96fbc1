"""Exact top-k search by norm-bucketed retrieval.

Vectors become integers floor(scale * x); the score is their inner product. Vectors are range-partitioned
by falling length (ties by id) into shards of about ``SHARD`` rows, so a shard holds one range of
lengths. Each query first gets a lower bound t of its k-th score from ``SEEDS`` long vectors, a bounded
set collected once. It is then sent to those shards only whose longest vector l can reach it, |q| l >= t: queries
and shards meet in an equi-join on length classes (``CLASSES`` per octave), and the exact bound is applied to
what meets. A shard's task first receives its vectors and cuts them by falling length into buckets of ``BUCKET``;
then its queries stream by in blocks of ``BLOCK``. For query q with k-th best score t so far and a bucket
whose longest vector is l, the local cosine threshold is t / (|q| l): above 1, the bucket and all shorter
ones are skipped; from ``COORDINATE_FROM`` on, coordinate pruning keeps the vectors whose components at the
``FOCUS`` largest components of q lie in the range that the threshold allows; otherwise length pruning keeps
the prefix with |q| |p| >= t. What is left is verified by exact products. The best k of each shard meet in
one window, whose limit is applied before the shuffle.

Products are exact: in double precision where |q| |p| < 2^53, else in Python integers; scores beyond
64 bits are clipped, as are scaled components. Pruning bounds are widened by 1e-9, so ties are never lost.

Defined results: vectors that are null, empty, or hold null or non-finite components, and rows with a
null id, take no part; a vector meets vectors of its own dimension only; an id with several rows
counts once, with its smallest vector; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm.common import ship, stored
from factweave.llm.vectors import group_runs, matrix, usable

SHARD, BUCKET, BLOCK, SEEDS = 8192, 512, 256, 512
CLASSES = 4
COORDINATE_FROM, FOCUS = 0.7, 4
_SLACK = 1 + 1e-9


def _products(q: np.ndarray, p: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (q @ p.T).astype(np.int64)
    big = np.array([[int(sum(int(a) * int(b) for a, b in zip(x, y))) for y in p] for x in q], dtype=object).reshape(len(q), len(p))
    return np.clip(big, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Shard:
    """Vectors by falling length, in buckets, with their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        length = np.linalg.norm(vectors, axis=1)
        order = np.lexsort((ids, -length))
        self.ids, self.vectors, self.length = ids[order], vectors[order], length[order]
        self.unit = self.vectors / np.where(self.length > 0, self.length, 1)[:, None]

    def best(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
        """(query, id, score) of at least the k best of each query that reach ``floor`` (a lower bound of its k-th score)."""
        norm = np.linalg.norm(queries, axis=1)
        limit = floor.astype(np.float64).copy()
        top: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # (-score, id), sorted, at most k
        exact = len(self.ids) == 0 or float(norm.max(initial=0)) * float(self.length[0]) * _SLACK < 2.0 ** 53
        for start in range(0, len(self.ids), BUCKET):
            part = slice(start, min(start + BUCKET, len(self.ids)))
            length, longest = self.length[part], self.length[start]
            live = np.flatnonzero(norm * longest * _SLACK >= limit)
            if not len(live):
                break  # later buckets are shorter, limits only rise
            with np.errstate(divide="ignore", invalid="ignore"):
                cosine = np.where(norm[live] * longest > 0, limit[live] / (norm[live] * longest), -1.0)
            focused = cosine >= COORDINATE_FROM
            for i in live[focused]:
                rows = self._in_range(part, queries[i] / norm[i], limit[i] / norm[i])
                if len(rows):
                    self._merge(top, limit, i, query_ids[i], rows, _products(queries[i:i + 1], self.vectors[rows], exact)[0], k)
            rest = live[~focused]
            if len(rest):
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(norm[rest] > 0, limit[rest] / norm[rest], np.where(limit[rest] > 0, np.inf, -np.inf)).min()
                n = int(np.searchsorted(-length, -need / _SLACK, side="right")) if need > 0 else len(length)
                scores = _products(queries[rest], self.vectors[start:start + n], exact)
                for i, s in zip(rest, scores):
                    rows = np.flatnonzero(s >= limit[i])
                    if len(rows):
                        self._merge(top, limit, i, query_ids[i], rows + start, s[rows], k)
        return [(int(q), i, -s) for q, t in zip(query_ids, top) for s, i in t]

    def _in_range(self, part: slice, unit: np.ndarray, need: float) -> np.ndarray:
        """Rows of the bucket whose focus components are compatible with a product of at least ``need`` with the unit query."""
        cosine = np.minimum(need / np.maximum(self.length[part], 1e-300), 1.0)  # per vector: the least cosine it needs
        spread = np.sqrt(np.maximum(1 - cosine ** 2, 0))
        keep = self.length[part] * _SLACK >= need
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            reach = spread * np.sqrt(max(1 - unit[f] ** 2, 0.0)) + 1e-9
            low = np.where(-unit[f] >= cosine, -1 - 1e-9, cosine * unit[f] - reach)
            high = np.where(unit[f] >= cosine, 1 + 1e-9, cosine * unit[f] + reach)
            keep &= (self.unit[part, f] >= low) & (self.unit[part, f] <= high)
        return np.flatnonzero(keep) + part.start

    def _merge(self, top, limit, i, own, rows, scores, k):
        found = [(-int(s), int(v)) for s, v in zip(scores, self.ids[rows]) if v != own]
        if found:
            merged = sorted(top[i] + found)[:k]
            top[i] = merged
            if len(merged) == k:
                limit[i] = max(limit[i], -merged[-1][0])


def _first_limits(queries: DataFrame, seeds: list, k: int) -> DataFrame:
    """Adds ``floor``: a lower bound of each query's k-th score, from its products with the seeds."""
    def run(batches):
        seed = {}
        for d in {s[0] for s in seeds}:
            mine = [s for s in seeds if s[0] == d]
            x = np.array([s[2] for s in mine], dtype=np.float64)
            seed[d] = (np.array([s[1] for s in mine]), x, float(np.linalg.norm(x, axis=1).max()))
        for batch in batches:
            floor, dims = np.full(batch.num_rows, -np.inf), batch.column("dim").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            for d in np.unique(dims).tolist():
                if d not in seed or len(seed[d][0]) <= k:
                    continue
                at = np.flatnonzero(dims == d)
                s_ids, s, longest = seed[d]
                for i in range(0, len(at), BLOCK):
                    some = at[i:i + BLOCK]
                    q = matrix(batch.column("v").take(pa.array(some)), d).astype(np.float64)
                    if float(np.linalg.norm(q, axis=1).max()) * longest * _SLACK < 2.0 ** 53:
                        scores = np.where(ids[some][:, None] == s_ids[None, :], -np.inf, q @ s.T)
                        floor[some] = np.partition(scores, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], names=[*batch.schema.names, "floor"])

    return queries.mapInArrow(run, "dim int, vec_id long, v array<double>, length double, floor double")


def _length_class(length):
    """Whole number that grows with ``length``; -1 for lengths below 1 (whole vectors: the zero vector)."""
    return F.when(length < 1, F.lit(-1)).otherwise(F.floor(F.log2(length) * CLASSES).cast("int"))


def route(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """``queries`` (with ``length`` and ``floor``), once for every ``shard`` of ``rows`` that can hold one of their best vectors."""
    shards = rows.groupBy("dim", "shard").agg(F.max("length").alias("longest")).withColumn("class", _length_class(F.col("longest")))
    top = shards.agg(F.max("class")).first()[0]
    need = F.col("floor") / F.col("length") / _SLACK  # the least length that reaches the floor
    low = F.when((F.col("length") > 0) & (need > 1), F.least(_length_class(need) - 1, F.lit(top))).otherwise(F.lit(-1))
    classes = queries.withColumn("class", F.explode(F.sequence(low, F.lit(top)))) if top is not None else queries.withColumn("class", F.lit(-1))
    reach = F.col("length") * F.col("longest") * _SLACK >= F.col("floor")
    return classes.join(shards, ["dim", "class"]).filter(reach | F.isnan(F.col("length") * F.col("longest"))).drop("class", "longest")


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other vectors of every vector that satisfies ``is_query`` (a condition on vec_id)."""
    spark = vectors.sparkSession
    ship(spark)
    valid = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).filter(usable("v") & F.col("vec_id").isNotNull())
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sized = stored(valid.select("vec_id", whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
                   .select(F.size("v").alias("dim"), "vec_id", "v", length.alias("length")))
    shards = max(1, -(-sized.count() // SHARD))
    rows = stored(sized.repartitionByRange(shards, "dim", F.col("length").desc(), "vec_id").withColumn("shard", F.spark_partition_id()))
    seeds = [(r.dim, r.vec_id, r.v) for r in rows.orderBy(F.col("length").desc(), "vec_id").limit(SEEDS).collect()]
    queries = _first_limits(rows.filter(is_query).select("dim", "vec_id", "v", "length"), seeds, k)
    both = rows.select("dim", "shard", F.lit(0).alias("kind"), "vec_id", "v", F.lit(0.0).alias("floor")) \
        .unionByName(route(queries, rows).select("dim", "shard", F.lit(1).alias("kind"), "vec_id", "v", "floor"))
    dealt = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind")

    def run(batches):
        key, held, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dim", "shard", "kind")], axis=1)
            ids, floor, out = batch.column("vec_id").to_numpy(), batch.column("floor").to_numpy(), []
            for a, b in zip(*group_runs(keys)):
                dim, number, kind = keys[a].tolist()
                if (dim, number) != key:
                    key, held, shard = (dim, number), [], None
                m = matrix(batch.column("v").slice(a, b - a), dim).astype(np.float64)
                if kind == 0:
                    held.append((ids[a:b].copy(), m.copy()))
                    continue
                if shard is None:
                    shard = Shard(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                for i in range(0, b - a, BLOCK):
                    part = slice(a + i, min(a + i + BLOCK, b))
                    out += shard.best(ids[part], m[i:i + BLOCK], floor[part], k)
            x = np.array(out, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, c]) for c in range(3)], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
