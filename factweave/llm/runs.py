"""Periodic run detection over the words of whole texts by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
``min_length`` words and three periods long, that no neighbouring word extends keeping period q. All runs
of a text are found, exactly:

* Periods below ``FIRST_SCALE`` are too short for minimizers: one direct scan per lag.
* Scale Q serves the periods q in [Q, 2Q). Each window of w = Q/8 grams of m = Q/8 words selects its
  smallest gram hashes (all on ties). Selection depends on the words around a position alone, so inside a
  run the selected positions repeat at distance q. Pairs of selected positions with equal grams at a
  distance in [Q, 2Q) are the seeds of that scale. The grams of a scale come from those of the scale
  before by one combination, as m doubles.
* Equal grams at most m/2 apart overlap, so their stretch has a short period of its own; such chains (a
  word repeated a thousand times) would seed every multiple of that period. Only the first and the last
  position of a chain seed. A run of period q and three periods cannot hold one chain that covers all but
  its margins (the stretch would be at least q + m/2 long with both periods, hence by Fine and Wilf a
  smaller period would hold for the whole run), so a chain's first or last position has its copy q on.
* Seeds extend to the maximal stretch of equal words at their lag, seeds of one lag in one sweep; a
  stretch found at several lags is one run with the smallest of them as its period.

The work is near linear in a text's words and a text's runs, so one pass per Arrow batch of about 4 MB
suffices: no shuffle, and a lost executor costs its own partitions. Texts of a batch are searched
together, parted by words of their own that equal nothing. Gram hashes have 64 bits; what they seed is
compared word by word, so a collision costs time only (two grams of a chain would have to collide to lose a seed).

Defined results: a null or empty text has no words and no runs; repeated rows give repeated rows; a null
id stays null; an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import byte_chunks, map_text

FIRST_SCALE = 16      # smallest period found by minimizers
GATHER = 1 << 21      # words compared at once while seeds extend
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _doubled(h: np.ndarray, m: int) -> np.ndarray:
    """Hashes of the grams of 2m words from those of m words."""
    return _mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.roll(h, -m))


def _selected(h: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is the smallest of some window of ``w`` (a power of two) consecutive ones."""
    low, step = h, 1
    while step < w:                        # low[i] = min(h[i : i + w])
        low = np.minimum(low, np.roll(low, -step))
        step *= 2
    step = 1
    while step < w:                        # now the largest of the windows that hold a position
        low = np.maximum(low, np.roll(low, step))
        step *= 2
    return np.flatnonzero(h == low)


def _seeds(pos: np.ndarray, gram: np.ndarray, scale: int, chain: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of the pairs of equal grams at lags in [scale, 2 scale), chains by their ends only."""
    order = np.argsort(gram, kind="stable")
    g, p = gram[order], pos[order]
    tied = (g[1:] == g[:-1]) & (p[1:] - p[:-1] <= chain)
    at, lag = [], []
    for end in (np.append(True, ~tied), np.append(~tied, True)):
        ge, pe = g[end], p[end]
        for k in range(1, len(pe)):
            d = pe[k:] - pe[:-k]
            near = (ge[k:] == ge[:-k]) & (d < 2 * scale)
            if not near.any():
                break
            near &= d >= scale
            at.append(pe[:-k][near])
            lag.append(d[near])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.stack([np.concatenate(lag), np.concatenate(at)], axis=1), axis=0)
    return pair[:, 1], pair[:, 0]


def _agreement(x: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray, way: int) -> np.ndarray:
    """How many words from a on equal those from b on (way 1, a included) or before them (way -1), up to ``limit``."""
    n, live, block, last = np.zeros(len(a), np.int64), np.flatnonzero(limit > 0), 8, len(x) - 1
    while live.size:
        off = np.arange(block)
        done = n[live]
        i = np.clip(a[live][:, None] + way * (done[:, None] + off) - (way < 0), 0, last)
        j = np.clip(b[live][:, None] + way * (done[:, None] + off) - (way < 0), 0, last)
        same = (x[i] == x[j]) & (done[:, None] + off < limit[live][:, None])
        whole = same.all(axis=1)
        n[live] += np.where(whole, block, same.argmin(axis=1))
        live = live[whole]
        block = max(8, min(4 * block, GATHER // max(1, live.size)))
    return n


def _stretches(x: np.ndarray, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches [a, b) of words equal to those ``lag`` later around the seeds, which come sorted by (lag, position)."""
    far = np.full(len(at), len(x), np.int64)
    follows = np.zeros(len(at), bool)
    follows[:-1] = lag[1:] == lag[:-1]
    limit = far.copy()
    limit[:-1][follows[:-1]] = (at[1:] - at[:-1])[follows[:-1]]
    ahead = _agreement(x, at, at + lag, limit, 1)
    joined = follows & (ahead == limit)          # reaches the next seed of its lag: one stretch
    head = np.append(True, ~joined[:-1])
    back = _agreement(x, at[head], (at + lag)[head], far[head], -1)
    return at[head] - back, (at + ahead)[~joined], lag[head]


def runs_of(texts: list[np.ndarray], min_length: int = 24, periods: int = 3) -> list[list[tuple[int, int, int]]]:
    """Per array of word numbers its runs (start, length, period), by start and period. Needs ``periods`` >= 3."""
    out: list[list] = [[] for _ in texts]
    keep = [i for i, t in enumerate(texts) if len(t) >= min_length]
    if not keep:
        return out
    size = np.array([len(texts[i]) for i in keep])
    first = 1 + np.concatenate([[0], np.cumsum(size + 1)[:-1]])  # a parting word before, between and after the texts
    x = np.concatenate([[-1], *[part for k, i in enumerate(keep) for part in (texts[i], [-2 - k])]]).astype(np.int64)
    found = [np.zeros((0, 3), np.int64)]

    def take(a, b, lag, place):
        ok = b - a >= np.maximum(min_length, periods * lag) - lag
        found.append(np.stack([place[a[ok]], (b - a + lag)[ok], lag[ok]], axis=1))

    place = np.arange(len(x))
    for q in range(1, FIRST_SCALE):
        same = np.flatnonzero(x[q:] == x[:-q])
        if same.size:
            cut = np.flatnonzero(np.diff(same) != 1)
            a, b = same[np.append(0, cut + 1)], same[np.append(cut, same.size - 1)] + 1
            take(a, b, np.full(len(a), q), place)
    h, m, scale, words, sizes = _mixed(x.astype(np.uint64)), 1, FIRST_SCALE, x, size
    while (sizes >= periods * scale).any():
        if (long := sizes >= periods * scale).sum() < len(sizes):  # shorter texts cannot hold this scale's runs
            mask = np.append(True, np.repeat(long, sizes + 1))
            h, words, place, sizes = h[mask], words[mask], place[mask], sizes[long]
        while m < scale // 8:
            h, m = _doubled(h, m), 2 * m
        pos = _selected(h, m)
        at, lag = _seeds(pos, h[pos], scale, m // 2)
        if at.size:
            take(*_stretches(words, at, lag), place)
        scale *= 2
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):  # one stretch found at several lags: the smallest is its period
        rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))]
        doc = np.searchsorted(first, rows[:, 0], side="right") - 1
        for k, (start, length, period) in zip(doc.tolist(), rows.tolist()):
            out[keep[k]].append((start - int(first[k]), length, period))
        for i in {keep[k] for k in doc.tolist()}:
            out[i].sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when every run is cut to its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def periodic_runs(docs: DataFrame, min_length: int = 24, prepare: Callable | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs (start, length, period) of every text by start and period, and its
    words joined by one space without what repeats a run's first period. ``prepare(doc_id, words)`` may replace a text's list of words."""
    def run(batches):
        for rows, texts in byte_chunks(batches, "text"):
            split = [t.split() for t in texts]
            if prepare:
                split = [prepare(i, w) for i, w in zip(rows.column(0).to_pylist(), split)]
            number: dict[bytes, int] = {}
            for w in split:
                for word in set(w).difference(number):
                    number[word] = len(number)
            found = runs_of([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in split], min_length)
            collapsed = [b" ".join(w) if not r else b" ".join([word for word, k in zip(w, kept_words(len(w), r)) if k]) for w, r in zip(split, found)]
            yield (rows.column(0), [len(w) for w in split], [[dict(zip(("start", "length", "period"), r)) for r in f] for f in found],
                   pa.array([c.decode("utf-8", "replace") for c in collapsed], pa.string()))

    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
                    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """One row per document of ``periodic_runs``: n_runs, the run of the greatest exponent (smallest start, then period, on ties), digests."""
    # exponents compare as fractions: a is greater than b if length_a * period_b > length_b * period_a
    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda a, r: F.when(
        a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
