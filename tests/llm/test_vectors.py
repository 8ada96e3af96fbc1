"""Exact top-k search and embedding dedup against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from factweave.llm import embedding_dedup, topk
from tests.conftest import SF_SMALL
from tests.llm import brute

ODD = [(5000, None), (5001, []), (5002, [None] * 12), (5003, [float("nan")] * 12), (5004, [float("inf")] * 12), (5010, [0.0] * 12),
       (6000, [1.0, 2.0]), (6003, [1.0, 2.0]), (None, [1.0] * 12), (0, [0.5] * 12)]


def cloud(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(10, 12))
    return [[float(np.float32(a)) for a in base[rng.integers(10)] * rng.choice([1, 2]) + rng.normal(size=12) * rng.choice([0, 0.05, 0.1, 0.2])] for _ in range(n)]


@pytest.mark.parametrize("sizes", [(8192, 512, 256), (200, 32, 7)])
def test_top_k_equals_all_pairs(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD", "BUCKET", "BLOCK"), sizes):
        monkeypatch.setattr(topk, name, value)
    data = list(enumerate(cloud(900, 1))) + ODD + [(7002, [3e8] * 12), (7005, [-4e7] * 12)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 AS shard", "2 AS dim")
    assert brute.rows(topk.top_k(df, F.col("vec_id") % 3 == 0)) == brute.top_k(data, 5, lambda i: i % 3 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0


def test_queries_visit_the_lengths_they_can_reach(spark, monkeypatch):
    """Lengths fall by shard; a query goes to the shards whose longest vector reaches its first limit, and to no other."""
    monkeypatch.setattr(topk, "SHARD", 50)
    rng = np.random.default_rng(11)
    data = [(i, [float(a) for a in rng.normal(size=12) * 2.0 ** -(i % 9)]) for i in range(900)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    seen, plain = [], topk.route

    def noted(queries, rows):
        shards = {r.shard: (r.low, r.high) for r in rows.groupBy("shard").agg(F.min("length").alias("low"), F.max("length").alias("high")).collect()}
        wanted = {(q.vec_id, s) for q in queries.collect() for s, (_, high) in shards.items() if q.length * high * (1 + 1e-9) >= q.floor}
        out = plain(queries, rows)
        seen.append((shards, wanted, {(r.vec_id, r.shard) for r in out.collect()}))
        return out

    monkeypatch.setattr(topk, "route", noted)
    assert brute.rows(topk.top_k(df, F.col("vec_id") % 3 == 0)) == brute.top_k(data, 5, lambda i: i % 3 == 0)
    shards, wanted, got = seen[0]
    bounds = [shards[s] for s in sorted(shards)]
    assert len(bounds) >= 15 and all(a[0] >= b[1] for a, b in zip(bounds, bounds[1:]))
    assert got == wanted and 2 * len(got) < 300 * len(shards)


@pytest.mark.parametrize("how", [{}, {"bits": 10, "block": 40}, {"bits": 3, "block": 100}])
def test_dedup_equals_all_pairs(spark, how):
    data = [(i, i % 2, x) for i, x in enumerate(cloud(700, 2))] + [(i, 1, x) for i, x in ODD[:-1]] + [(8000, None, [1.0] * 12), (8001, 0, [2.0, 4.0]), (8002, 0, [1.0, 2.0])]
    data += [data[3], (8003, 0, data[4][2]), (8004, 0, data[4][2])]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 AS rep", "2 AS cell")
    want = brute.cosine_groups(data)
    assert brute.rows(embedding_dedup.embedding_dedup(df, **how)) == want and sum(r[1] for r in want) > 1000
    if not how:
        assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_four_bands_equal_all_pairs(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 64))
    data = [(i, 0, [float(np.float32(a)) for a in base[rng.integers(40)] + rng.normal(size=64) * rng.choice([0.02, 0.1, 0.14, 0.2])]) for i in range(500)]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
    want = brute.cosine_groups(data)
    assert embedding_dedup.layout(6, 64) == (4, 6) and sum(r[1] for r in want) > 500
    assert brute.rows(embedding_dedup.embedding_dedup(df, bits=6, block=50)) == want


def test_dedup_of_the_whole_table(spark):
    d = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    data = [(r.vec_id, r.label, r.embedding) for r in d.collect()]
    assert brute.rows(embedding_dedup.embedding_dedup(d)) == brute.cosine_groups(data)


def test_estimate_bound_holds():
    rng = np.random.default_rng(5)
    r = embedding_dedup.rotation(12)
    for _ in range(2000):
        x = rng.normal(size=12)
        y = x + rng.normal(size=12) * rng.choice([0.01, 0.1, 1])
        x, y = r @ (x / np.linalg.norm(x)), r @ (y / np.linalg.norm(y))
        code = np.where(x >= 0, 1, -1) / np.sqrt(12)
        f, c = x @ code, x @ y
        assert abs(code @ y / f - c) <= np.sqrt(max(0, 1 - c * c)) * np.sqrt(max(0, 1 - f * f)) / f + 1e-9
