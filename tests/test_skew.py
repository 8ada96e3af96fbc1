"""Spread joins equal plain joins, and a key on half of the rows is no longer one task's work."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from factweave.operators.attach import attach_types
from factweave.operators.skew import PIECES, hot_keys, spread_join


@pytest.fixture(scope="module")
def sides(spark):
    many = [("hot", i % 50) for i in range(4000)] + [(f"k{i % 900}", i) for i in range(3000)] + [(None, i) for i in range(1000)] + [("", 1)]
    one = [("hot", "h"), ("", "e"), (None, "n"), ("absent", "a")] + [(f"k{i}", str(i)) for i in range(0, 900, 2)] + [("k4", "again")]
    return spark.createDataFrame(many, "k string, v int").repartition(6), spark.createDataFrame(one, "k string, w string")


def same(a, b):
    return a.columns == b.columns and Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain_join(sides, how):
    many, one = sides
    assert same(spread_join(many, one, "k", how, partitions=8), many.join(one, "k", how))


@pytest.mark.parametrize("how", ["inner", "right"])
def test_hot_right_side(sides, how):
    many, one = sides
    assert same(spread_join(one, many, "k", how, hot="right", partitions=8), one.join(many, "k", how))


def test_numeric_keys_and_empty_sides(spark):
    a = spark.createDataFrame([(7, i) for i in range(500)] + [(i, i) for i in range(300)], "k long, v int")
    b = spark.createDataFrame([(7, "x"), (8, "y")], "k long, w string")
    assert same(spread_join(a, b, "k", "left", partitions=4), a.join(b, "k", "left"))
    assert same(spread_join(a.limit(0), b, "k", "left", partitions=4), a.limit(0).join(b, "k", "left"))
    assert same(spread_join(a, b.limit(0), "k", "left_anti", partitions=4), a)


def test_copied_side_must_not_be_kept(sides):
    many, one = sides
    for how, hot in (("left", "right"), ("right", "left"), ("left_anti", "right"), ("full", "left")):
        with pytest.raises(ValueError):
            spread_join(many, one, "k", how, hot=hot)


def test_only_hot_keys_are_measured(sides):
    many, _ = sides
    found = {r["k"]: r["salts"] for r in hot_keys(many, "k", 8).collect()}
    assert set(found) == {"hot"} and 4 * PIECES <= found["hot"] <= 8 * PIECES  # 4000 of 7001 rows with a key


def test_no_task_over_twice_the_median(spark, sides):
    many = spark.range(40000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("v"))
    one = many.select("k").distinct().withColumn("w", F.length("k"))
    saved = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(saved, ("false", "-1", "8")):
            spark.conf.set(c, v)

        def loads(df):
            n = sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("w").alias("n")).collect())
            return n[-1] / n[len(n) // 2]
        assert loads(many.join(one, "k", "left")) > 5
        assert loads(spread_join(many, one, "k", "left")) <= 2
    finally:
        for c, v in saved.items():
            spark.conf.set(c, v)


def test_attach_spread_equals_attach(spark):
    t = spark.createDataFrame([("hot", []), ("x", ["/a/b"]), (None, []), ("y", ["/base/z"])] * 300, "arg1 string, arg1_types array<string>")
    p = spark.createDataFrame([("hot", [("/t/1",)]), ("hot", [("/t/2",)]), ("y", [("/t/3",)])], "arg string, types array<struct<type: string>>")

    def rows(df):
        return Counter(repr(r) for r in df.select("arg1", "arg1_types", "types_attached").collect())
    assert rows(attach_types(t, p, spread=True)) == rows(attach_types(t, p))
