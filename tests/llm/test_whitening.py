"""Whitening against exact integer sums and a plain eigensolver."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import Row

from factweave.llm import whitening
from factweave.llm.queries import op13_whitening
from tests.conftest import SF_SMALL


def matrix(values, seed=0):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    q = q @ (1.5 * np.eye(d, dtype=q.dtype) - .5 * q.T @ q)
    a = (q * np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    list(np.linspace(1, 50, 64)), [1.0] * 8 + [2.0] * 8, [1 + 1e-9 * i for i in range(12)] + [3, 4], [1e-12 * i for i in range(1, 20)] + [1, 1 + 1e-13, 5],
    [0.0, 0.0, 1e8, 1e8 + 1], list(10 ** np.linspace(0, 8, 40)), [3.0], [0.0, 0.0]])
def test_refined_vectors(values):
    a = matrix(values)
    e, x = whitening.refined_eigh(a)
    size = max(1e-300, float(np.abs(a).max()))
    assert np.abs(a @ x - x * e).max() <= 1e-16 * size and np.abs(x.T @ x - np.eye(len(a))).max() <= 1e-16
    assert np.allclose(np.array(sorted(values, reverse=True)), e.astype(float), rtol=1e-14, atol=1e-15 * size)


@pytest.mark.parametrize("peak", [900, 1 << 30, 1 << 45])
def test_gram_is_exact(peak):
    y = np.random.default_rng(1).integers(-peak, peak, (9000, 3))
    z = y.astype(object)
    assert (whitening.gram(y, peak) == z.T @ z).all()


def rows_of(df):
    return {(r.vec_id, r.component): r for r in df.collect()}


def expected(data, k=8):
    kept = [(i, v) for i, v in data if v and all(a is not None and math.isfinite(a) for a in v)]
    x = [[math.floor(1024 * float(np.float32(a))) + 100_000 for a in v] for _, v in kept]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    z = np.array([[float(Fraction(n * r[j] - s[j], n)) for j in range(d)] for r in x])
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return kept, n, dev, z @ u / np.sqrt(e), e / np.trace(v)


def test_rows_equal_exact_sums(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(np.float32(a)) for a in rng.normal(size=12) * np.arange(1, 13) + 3]) for i in range(400)]
    data += [(400, None), (401, []), (402, [None] * 12), (403, [math.nan] * 12), (404, [math.inf] * 12), (405, [1.0, 2.0]), data[7], (None, data[9][1])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS n", "1 AS component", "2 AS v").repartition(5)
    got = whitening.whiten(df).collect()
    kept, n, dev, white, share = expected([(i, v) for i, v in data if i != 405])
    assert len(got) == 8 * len(kept) == 8 * 402 and all(r.n == n for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    by = {(r.vec_id, r.component): r for r in got}
    sign = [None] * 8
    for row, (i, _) in enumerate(kept):
        for c in range(8):
            r = by[i, c + 1]
            assert int(r.deviation) == dev[row] and r.explained == pytest.approx(share[c], rel=1e-9)
            if sign[c] is None and abs(white[row, c]) > 0.1:
                sign[c] = math.copysign(1, r.whitened * white[row, c])
    for row, (i, _) in enumerate(kept):
        for c in range(8):
            assert by[i, c + 1].whitened == pytest.approx(sign[c] * white[row, c], abs=1e-8)
    fitted = [c for c in got[0].__fields__ if c != "identity_error"]  # that one is measured by float sums
    again = whitening.whiten(df.repartition(2)).select(fitted).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, (Row(**{c: r[c] for c in fitted}) for r in got)))  # the fit does not depend on the partitions


def test_no_rows_no_variance_and_large_entries(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], schema)).collect()
    assert len(same) == 15 and all(r.whitened is None and r.explained is None and r.identity_error == 0 and r.deviation == 0 for r in same)
    flat = whitening.whiten(spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], schema)).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)} and flat[0].identity_error < 1e-12
    big = [(i, [1e11 * (i + 1), -2e10 * i * i]) for i in range(6)]
    out = rows_of(whitening.whiten(spark.createDataFrame(big, schema)))
    x = [[math.floor(1024 * a) + 100_000 for a in v] for _, v in big]
    s = [sum(c) for c in zip(*x)]
    assert [int(out[i, 1].deviation) for i in range(6)] == [sum((6 * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    huge = whitening.whiten(spark.createDataFrame([(0, [1e300]), (1, [-1e300])], schema)).collect()
    assert len(huge) == 2 and huge[0].identity_error < 1e-12


def test_registered_query(spark):
    got = op13_whitening(spark, SF_SMALL)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    first = got.first()
    assert got.count() == 8 * first.n and first.identity_error < 1e-6 and got.filter("deviation IS NULL").count() == 0
