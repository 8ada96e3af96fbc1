"""Periodic runs against a scan of every lag of every text."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from factweave.llm import runs
from factweave.llm.queries import planted_period
from tests.llm import brute


def all_runs(x, shortest=24, periods=3):
    """Every maximal stretch at every lag; a stretch met at several lags has the smallest as its period."""
    n, out = len(x), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            a = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            if i > a and i - a + q >= max(shortest, periods * q):
                out.setdefault((a, i - a + q), q)
            i += i == a
    return sorted(((s, k, q) for (s, k), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(rng, n, alphabet, times):
    x = [rng.randrange(alphabet) for _ in range(n)]
    for _ in range(times if n else 0):
        s = rng.randrange(n)
        p = 1 + rng.randrange((n - s) // rng.choice([1, 2, 3, 4, 8, 20]) + 1)
        for i in range(s + p, min(n, s + p * rng.choice([2, 3, 4, 9]) + rng.randrange(p + 1))):
            x[i] = x[i - p]
    return x


def test_runs_equal_a_scan_of_every_lag():
    rng, found = random.Random(4), 0
    for _ in range(70):
        texts = [planted(rng, rng.choice([0, 5, 23, 24, 60, 200, 700, 1500]), rng.choice([1, 2, 3, 50, 5000]), rng.choice([0, 1, 3, 6])) for _ in range(rng.choice([1, 4, 12]))]
        got = runs.runs_of([np.array(t, np.int64) for t in texts])
        want = [all_runs(t) for t in texts]
        assert got == want
        found += sum(map(len, want))
    assert found > 100


@pytest.mark.parametrize("period", [1, 2, 7, 15, 16, 17, 31, 32, 33, 63, 64, 100, 127, 128, 129, 500])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_shortest_runs_of_a_period(period, extra):
    rng = random.Random(period)
    unit = list(range(1, period + 1))
    body = (unit * (max(3, -(-24 // period)) + 1))[:max(24, 3 * period) + extra]
    text = [rng.randrange(10_000, 10_000_000) for _ in range(40)] + body + [rng.randrange(10_000, 10_000_000) for _ in range(50)]
    assert runs.runs_of([np.array(text)])[0] == ([] if extra < 0 else [(40, len(body), period)])


def test_nested_and_overlapping_runs():
    fib = [0], [0, 1]
    while len(fib[1]) < 1500:
        fib = fib[1], fib[1] + fib[0]
    nested = (([1] * 40 + [2]) * 9 + ([1] * 40 + [3]) * 7) * 3
    steps = [v for k in range(1, 40) for v in [0] * k + [1]]
    for x in (fib[1], nested, steps, [0] * 3000, ([0] * 100 + [1]) * 12, ([0, 1] * 30 + [2]) * 8, (([0] * 30 + [1]) * 4 + [2]) * 5):
        assert runs.runs_of([np.array(x)])[0] == all_runs(x)


def test_query_rows(spark, documents, texts):
    rows = documents.select("doc_id", "text", "key")
    repeats = "lorem ipsum dolor sit amet " * 40 + "x y " * 200 + "end"
    extra = spark.createDataFrame([(30_000 + i, t, 1) for i, t in enumerate([repeats, "a " * 100_000, None, "b c  d\n" * 8])], "doc_id long, text string, key int")
    data = texts + [(r.doc_id, r.text) for r in extra.collect()]
    got = brute.rows(runs.run_digests(runs.periodic_runs(rows.unionByName(extra), prepare=planted_period)).drop("n_words"))
    want = []
    for i, t in data:
        words = brute.WORD.findall(t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
        x = [numbers[w] for w in words]
        found = all_runs(x) if len(numbers) > 1 else [(0, n, 1)] if n >= 24 else []
        gone = {k for s, length, q in found for k in range(s + q, s + length)}
        best = None
        for r in found:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        want.append((i, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest(),
                     hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()))
    assert got == sorted(want, key=repr) and sum(r[1] for r in want) > 5
    assert runs.periodic_runs(documents.limit(0)).count() == 0
