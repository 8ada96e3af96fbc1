"""The suffix rules of the key normaliser: known forms, other scripts, and stemming twice changes nothing."""

import duckdb
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from factweave import constants as C
from factweave.functions import normalize_arg_tokens, stem_tokens
from factweave.plans import sql_twins as S

FORMS = {"cities": "city", "ties": "tie", "classes": "class", "boxes": "box", "dishes": "dish", "churches": "church", "rings": "ring", "class": "class",
         "virus": "virus", "basis": "basis", "gas": "gas", "men": "man", "mens": "man", "news": "news", "movies": "movie", "ciónes": "cióne",
         "écoles": "école", "s": "s", "": "", "is": "is", "77s": "77s", "houses": "house", "the": "the", "женщиныs": "женщины"}
words = st.lists(st.text(alphabet="aeiouyscxhzlé", max_size=4), max_size=3).flatmap(
    lambda parts: st.sampled_from(["", "s", "es", "ies", "sses", "shes", "xes", "ss", "us", "zzes", "men", *C.STEM_EXCEPTIONS]).map(lambda end: "".join(parts) + end))


def stems(spark, tokens):
    df = spark.createDataFrame([(list(tokens),)], "t array<string>")
    once = df.select(stem_tokens(F.col("t")).alias("a"))
    return tuple(once.select("a", stem_tokens(F.col("a")).alias("b")).first())


def test_known_forms(spark):
    assert stems(spark, FORMS)[0] == list(FORMS.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(words, min_size=50, max_size=300))
def test_twice_is_once_and_sql_agrees(spark, tokens):
    once, twice = stems(spark, tokens)
    assert once == twice
    assert once == duckdb.execute(f"SELECT {S.stem('$1::VARCHAR[]')}", [tokens]).fetchone()[0]


def test_exceptions_are_final(spark):
    singular = sorted(set(C.STEM_EXCEPTIONS.values()))
    assert stems(spark, singular)[0] == singular
    assert stems(spark, C.STEM_EXCEPTIONS)[0] == list(C.STEM_EXCEPTIONS.values())


def test_key_of_null_and_of_no_tokens(spark):
    df = spark.createDataFrame([(None,), ([],), (["The", "Cities"],)], "t array<string>")
    assert [r[0] for r in df.select(normalize_arg_tokens("t")).collect()] == [None, "", "the city"]
