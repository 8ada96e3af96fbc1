"""TX3 - confidence of an extraction.

A logistic function over boolean features of the token spans (the features follow the
published description of the relation-phrase extractor's confidence function; the weights
are our configuration in ``constants.CONF_WEIGHTS``). Pure column expressions: the score
runs inside whole-stage codegen. Invalid spans leave the instance unscored (NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave import constants as C

PREPOSITIONS = sorted(w for w, t in C.LEXICON.items() if t in ("IN", "TO"))


def span_valid(tokens="tokens") -> Column:
    n = F.size(F.col(tokens))
    ok = F.lit(True)
    for p in ("arg1", "rel", "arg2"):
        s, ln = F.col(f"{p}_start"), F.col(f"{p}_len")
        ok = ok & s.isNotNull() & ln.isNotNull() & (s >= 0) & (ln > 0) & (s + ln <= n)
    return F.coalesce(ok, F.lit(False))  # NULL tokens: invalid, not unknown


def features(tokens="tokens") -> dict[str, Column]:
    t = F.col(tokens)
    n = F.size(t)
    rel_last = F.lower(F.try_element_at(t, F.col("rel_start") + F.col("rel_len")))
    a1 = F.array_join(F.slice(t, F.col("arg1_start") + 1, F.col("arg1_len")), " ")
    a2 = F.array_join(F.slice(t, F.col("arg2_start") + 1, F.col("arg2_len")), " ")
    return {
        "covers_sentence": (F.col("arg1_len") + F.col("rel_len") + F.col("arg2_len")) == n,
        "starts_sentence": F.col("arg1_start") == 0,
        "short_sentence": n <= 10,
        "long_sentence": n > 20,
        "rel_ends_prep": rel_last.isin(*PREPOSITIONS),
        "rel_single_verb": F.col("rel_len") == 1,
        "arg2_ends_sentence": (F.col("arg2_start") + F.col("arg2_len")) == n,
        "arg_has_digit": a1.rlike("[0-9]") | a2.rlike("[0-9]"),
    }


def confidence(tokens="tokens") -> Column:
    """Confidence in (0, 1), 6 decimals, NULL when the spans do not address real tokens."""
    f = features(tokens)
    z = F.lit(C.CONF_INTERCEPT)
    for name, w in C.CONF_WEIGHTS.items():
        z = z + F.when(f[name], F.lit(w)).otherwise(F.lit(0.0))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return F.when(span_valid(tokens), p.cast("decimal(9,6)").cast("double"))


def score(df: DataFrame, only_unscored: bool = False, out: str = "confidence") -> DataFrame:
    """Attach ``confidence``; with ``only_unscored`` keep existing values >= 0 (regroup rule)."""
    c = confidence()
    if only_unscored and out in df.columns:
        c = F.when(F.col(out).isNotNull() & (F.col(out) >= 0), F.col(out)).otherwise(c)
    return df.withColumn(out, c)
