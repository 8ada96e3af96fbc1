"""Registered queries against their DuckDB twins (the driver's gate, on sf0.001)."""

import re

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import check, duck

import __spark_entry__ as E

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = check(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    spark.catalog.clearCache()
    assert r["match"], r


def test_every_query_has_a_twin_or_is_rows_only():
    rows_only = {q for q in set(E.queries()) - set(E.oracle_sql()) if not re.match(r"op\d+_|pipeline$", q)}
    assert not rows_only, rows_only


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
