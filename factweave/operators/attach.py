"""Attach predicted types to tuples (JN2, JN3, PF14; the original's type attacher).

tuples LEFT JOIN predictions on the argument string. A tuple takes the predicted types
only when its own *filtered* type set is empty (so a tuple whose only types are
blacklisted or '/base/' counts as untyped and is overwritten, Q9); other tuples pass
unchanged; several predictions for one argument fan out, as in the original.

JN3: the original salts arguments shorter than 4 characters with a random prefix on both sides so
that these hot short keys spread out, and loses their matches by it. Here every key joins as it is, and the
prediction side has one row per argument. A hot key's side of the join is split by adaptive execution where the
tuples come as they are; with ``spread=True`` the keys that are hot by measurement, short or long, are salted on
both sides (``skew.spread_join``), which also serves tuples whose partitioning is fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import filter_types
from factweave.operators.skew import spread_join


def attach_types(tuples: DataFrame, predictions: DataFrame, role: str = "arg1", spread: bool = False) -> DataFrame:
    """``predictions``: (arg, types ARRAY<STRUCT<type, ...>>) as produced by the typer.

    Replaces (never unions) ``<role>_types`` - and only that role's column (the original's
    arg2 setter wrote into arg1, Q2; fixed).
    """
    if role not in ("arg1", "arg2"):
        raise ValueError("role must be either arg1 or arg2")
    p = predictions.select(F.col("arg").alias("_k"),
                           F.array_sort(F.array_distinct(F.transform("types", lambda t: t["type"]))).alias("_pt"))
    t = tuples.withColumn("_k", F.col(role))
    j = spread_join(t, p, "_k", "left") if spread else t.join(p, "_k", "left")
    untyped = F.size(filter_types(f"{role}_types")) == 0
    new = F.when(F.col("_pt").isNotNull() & untyped, F.col("_pt")).otherwise(F.col(f"{role}_types"))
    return j.withColumn("types_attached", F.col("_pt").isNotNull() & untyped) \
        .withColumn(f"{role}_types", new).drop("_k", "_pt")


def types_to_strings(type_ints: DataFrame, type_dim: DataFrame, col: str = "type_enum") -> DataFrame:
    """JN4 int -> string direction: unknown ints are dropped (the original's behaviour)."""
    return type_ints.join(type_dim.select(F.col("enum").alias(col), "type"), col, "inner")


def types_to_ints(type_strings: DataFrame, type_dim: DataFrame, col: str = "type"):
    """JN4 string -> int direction. The original fails on an unknown string (Q10); we return
    (known rows with ``enum``, rejected rows) so unknown strings can be counted."""
    d = type_dim.select(F.col("type").alias(col), "enum")
    return type_strings.join(d, col, "inner"), type_strings.join(d, col, "left_anti")
