import pytest

from tests.conftest import SF_SMALL

ODD_TEXTS = [None, "", " \n\t ", "a", "A b", "x" * 30_000, "word " * 6_000, "é́ 中文 ½ \x85   \x1c end", "a\n\n\n  b  \n", "<|endoftext|> x <|startoftext|>"]


@pytest.fixture(scope="session")
def documents(spark):
    """The small table, odd texts, a repeated row, a null id, and columns whose names the operators use themselves."""
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    odd = [(9_000 + i, t, None, f"src{i % 2}" if i else None, None) for i, t in enumerate(ODD_TEXTS)]
    odd += [(9_100, "same row twice", "en", "src0", 14), (9_100, "same row twice", "en", "src0", 14), (None, "no id", "en", "srcé", 5)]
    both = d.unionByName(spark.createDataFrame(odd, d.schema))
    both = both.selectExpr("*", "'x' AS size", "1 AS key", "2 AS score", "'y' AS fp", "0.5 AS row", "3 AS c0", "4 AS copies").coalesce(3).cache()
    assert both.count() == 133
    return both


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
