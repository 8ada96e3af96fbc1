"""Row filters and sampling that are not specific to one pipeline stage (PF6, PF9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.functions import md5_order


def bernoulli_sample(df: DataFrame, fraction: float, key_cols: list[str] | None = None, seed: int | None = None) -> DataFrame:
    """PF9: keep each row with probability ``fraction``.

    With ``key_cols`` the decision is md5-based (first 32 bits of md5 of the '|'-joined
    key < fraction·2^32): deterministic, reproducible under task retries and checkable by SQL.
    Without, Spark's own Bernoulli sampler (``df.sample``) is used with ``seed``.
    """
    if not key_cols:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    thr = format(int(fraction * 16**8), "08x")
    return df.filter(F.substring(md5_order(*key_cols), 1, 8) < F.lit(thr))


def frequency_filter(groups: DataFrame, min_freq: int = 0, max_freq: int = 2**31 - 1, size_col: str = "n_instances"):
    """PF6: keep a group iff min_freq <= size <= max_freq (inclusive)."""
    return groups.filter(F.col(size_col).between(min_freq, max_freq))
