"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave import constants as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def computed_once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with ``cols`` added, each computed once per row whatever reads them later.

    They come out of a generator over a one-element array: predicates on a generator's output are not pushed below it,
    whereas a predicate on a plain column is, which puts the column's whole expression into every conjunct. A column of
    ``df`` that has one of the names is replaced.
    """
    row = F.struct(*[c.alias(k) for k, c in cols.items()])
    rest = [c for c in df.columns if c not in cols] if set(cols) & set(df.columns) else ["*"]
    return df.select(*rest, F.inline(F.array(row)))


def md5_order(*cols) -> Column:
    """Deterministic pseudo-random order key: md5 of the '|'-joined values.

    Replaces the original's random shuffles and arrival-order ``take``; equal in Spark and
    DuckDB, so samples can be checked with SQL.
    """
    return F.md5(F.concat_ws("|", *[col(c).cast("string") for c in cols]))


def lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def clean_control(c) -> Column:
    """Tab -> space, then delete every Unicode control/format/unassigned char (\\p{C})."""
    return F.regexp_replace(F.replace(col(c), F.lit("\t"), F.lit(" ")), r"\p{C}", "")


def filter_types(types) -> Column:
    """Drop '/base/...' types and blacklisted types from an array of type strings."""
    bl = lit_array(C.TYPE_BLACKLIST)
    return F.filter(col(types), lambda t: ~t.startswith(C.TYPE_DROP_PREFIX) & ~F.array_contains(bl, t))


def arg_string_ok(arg) -> Column:
    """Argument may be typed: length >= 4, no run of 3+ digits, not exactly a stop word."""
    a = col(arg)
    return (F.length(a) >= C.MIN_ARG_LENGTH) & ~a.rlike("[0-9]{3}") & ~a.isin(*C.ARG_STOP_WORDS)


def rel_string_ok(rel) -> Column:
    r = col(rel)
    return (F.length(r) >= C.MIN_REL_LENGTH) & (F.length(r) <= C.MAX_REL_LENGTH)


def span_text(tokens, start, length) -> Column:
    """Text of a token span (0-based start, length) joined by single spaces."""
    return F.array_join(F.slice(col(tokens), col(start) + 1, col(length)), " ")


def span_tokens(tokens, start, length) -> Column:
    return F.slice(col(tokens), col(start) + 1, col(length))


# Suffix rules, the longest matching first: (letters that must stand before, suffix, replacement). [^\P{L}...]: a letter but those.
STEM_RULES = [
    (r"\p{L}{2,}", "ies", "y"),                                 # cities; ties keeps its e by the last rule
    (r"\p{L}+(?:ss|sh|ch|zz)|\p{L}{2,}x", "es", ""),            # classes, dishes, boxes
    (r"\p{L}{2,}[^\P{L}sui]", "s", ""),                         # rings; not class, virus, basis
]
RULE_ENDS = ("s", "\n", "\r", "\u0085", "\u2028", "\u2029")  # the last character of what a rule may match


def stem_tokens(tokens) -> Column:
    """Every (lower-case) token without its plural or third-person ending, letters of any script.

    The exception table decides first, then the suffix rules, and the table once more for what they leave (``mens``). Stemming
    twice changes nothing. Each step is an array of its own, so no rule runs twice.
    """
    table = F.create_map(*[F.lit(x) for pair in C.STEM_EXCEPTIONS.items() for x in pair])

    def rules(t: Column) -> Column:
        for before, suffix, put in STEM_RULES:
            t = F.regexp_replace(t, f"^({before}){suffix}$", f"$1{put}")
        return t

    def listed(t: Column, other: Column) -> Column:
        return F.when(t.isin(*C.STEM_EXCEPTIONS), F.try_element_at(table, t)).otherwise(other)
    # every rule ends in s; most tokens do not and meet no pattern ($ also stands before a final line break)
    cut = F.transform(tokens, lambda t: listed(t, F.when(F.substring(t, -1, 1).isin(*RULE_ENDS), rules(t)).otherwise(t)))
    return F.transform(cut, lambda t: listed(t, t))


IRREGULAR = sorted(w for w in C.STEM_EXCEPTIONS if not w.endswith("s"))


def stemmed_text(tokens) -> Column:
    """The stemmed, lower-case ``tokens`` joined by spaces.

    A stem rule or the exception table can change a token only if some token ends in s or a line break or is one of the few
    listed words that do not; a sigma is lower-cased by its place in the word. Plain searches in the joined text rule that out for most phrases, which then need no look at
    single tokens; a search that finds too much (``ment`` holds ``men``) only sends the phrase the long way.
    """
    text = F.lower(F.array_join(tokens, " "))
    may = [text.endswith("s"), F.contains(text, F.lit("s ")), *[F.contains(text, F.lit(x)) for x in (*RULE_ENDS[1:], "\u03c3", "\u03c2", *IRREGULAR)]]
    plain = ~functools.reduce(lambda a, b: a | b, may)
    return F.when(plain, text).otherwise(F.array_join(stem_tokens(F.transform(tokens, lambda t: F.lower(t))), " "))


def normalize_arg_tokens(tokens) -> Column:
    """Grouping-key form of an argument: lower-case, stemmed tokens, space-joined."""
    return stemmed_text(col(tokens))


def normalize_rel_tokens(tokens) -> Column:
    """Grouping-key form of a relation: as arguments, without auxiliaries/determiners/adverbs."""
    return stemmed_text(F.filter(col(tokens), lambda t: ~F.lower(t).isin(*C.REL_DROP_WORDS)))


def weight_2dp(shared, pairs) -> Column:
    """shared/pairs rounded half-up to 2 dp, computed on integers (engine independent)."""
    s, p = col(shared).cast("long"), col(pairs).cast("long")
    return F.when(p == 0, F.lit(0.0)).otherwise(
        F.floor((F.lit(200) * s + p) / (F.lit(2) * p)).cast("long").cast("double") / 100.0)


def exp_weight(w2) -> Column:
    """10^(4·w), as DECIMAL(20,6) so that sums do not depend on the order of addition."""
    return F.pow(F.lit(10.0), F.lit(4.0) * col(w2)).cast("decimal(20,6)")
