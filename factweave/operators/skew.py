"""Joins on hot keys (JN3): measured, not guessed, and spread over many tasks.

Adaptive execution splits a hot partition of an inner join or of the preserved side of an outer join, when it comes
straight from a shuffle. It cannot where the skewed side is the other one, where an aggregation or window fixes the
partitioning, or for the rows of a full outer join. ``spread_join`` covers these, exactly:

1. ``hot_keys`` - a frequent-items sketch in one pass (a mergeable summary of a few thousand counters per task, so nothing
   grows with the data) names every key that alone fills more than one shuffle partition. There are at most as many of
   these as partitions. The sketch's counts only set how far a key is spread; the result does not depend on them.
2. The hot side's rows of such keys get one of the key's ``salts`` by a hash of the whole row and its input
   partition: the same rows get the same salts when a lost task runs again, and repeated rows of different input
   partitions are spread. Rows without a key match nothing, so they are spread over all partitions in the same way.
3. The other side's rows of hot keys are copied once per salt; all other rows travel as they are. The copies of a side
   with one row per key are at most ``PIECES`` x partitions rows in all. A key that is hot on both sides should be
   aggregated on one of them first: its rows there are copied per salt.

The list of hot keys is broadcast: it has at most ``partitions`` rows by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = 16  # pieces per partition's worth of rows: pieces meet in partitions by chance, small ones even out
MAX_HOT = 4096


def hot_keys(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """(key, salts): the keys that hold more rows than one of ``partitions`` equal parts, and how many pieces to make of them.

    NULL is no key: it joins with nothing. A key just at the bound may be missed or found; either is right.
    """
    most = min(partitions, MAX_HOT)
    name = F.col(key).cast("string")
    sketch = df.filter(name.isNotNull()).agg(F.expr(f"approx_top_k(cast(`{key}` as string), {most}, {8 * most + 1024})").alias("top"), F.count(name).alias("n"))
    share = F.col("t.count") / F.col("n")
    return sketch.select("n", F.explode("top").alias("t")).filter(share * partitions > 1) \
        .select(F.col("t.item").alias(key), F.ceil(share * partitions * PIECES).cast("int").alias("salts"))


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: str = "left",
                partitions: int | None = None) -> DataFrame:
    """``left`` join ``right`` on ``key``, the rows of hot keys of the ``hot`` side spread over the tasks.

    ``how``: inner, left, right, left_semi or left_anti, with the side that is kept being the hot one; inner takes either. (Kept rows of
    the copied side would come once per salt.) The columns are those of ``left.join(right, key, how)``; names that
    begin with ``_salt`` are taken.
    """
    kept = {"inner": ("left", "right"), "left": ("left",), "left_semi": ("left",), "left_anti": ("left",), "right": ("right",)}
    if how not in kept:
        raise ValueError(f"how must be one of {', '.join(kept)}")
    if hot not in kept[how]:
        raise ValueError(f"a {how} join keeps the other side's rows: they cannot be copied")
    parts = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full, other = (left, right) if hot == "left" else (right, left)
    keys = F.broadcast(hot_keys(full, key, parts).select(F.col(key).alias("_salt_key"), F.col("salts").alias("_salts")))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(keys, F.col(key).cast("string") == F.col("_salt_key"), "left").drop("_salt_key")

    row = F.xxhash64(*full.columns, F.spark_partition_id())
    spread = F.pmod(row, F.when(F.col(key).isNull(), F.lit(parts)).otherwise(F.col("_salts"))).cast("int")
    a = marked(full).withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    b = marked(other).withColumn("_salt", F.explode(every)).drop("_salts")
    left, right = (a, b) if hot == "left" else (b, a)
    return left.join(right, [key, "_salt"], how).drop("_salt")
