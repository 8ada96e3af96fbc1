"""Packing token sequences by order-preserving dynamic programming.

Each task tokenizes its documents in order (every document ends with ``end_id``) and lays their ids in
one line. Cuts are chosen by dynamic programming over allowed boundaries: document ends (free),
sentence ends (``SENTENCE_CUT``) and, inside sentences longer than ``HARD_STEP`` ids, hard points
(``HARD_CUT``): every ``HARD_STEP`` ids, and the places whole limits away from a boundary shortly before, so that
full sequences stay possible. The objective is padding plus penalties plus ``SEQUENCE_COST`` per sequence. A
sequence of length L costs ``limit - L`` padding, or none where L is a power of two, however short. For padded
sequences the best predecessor of a boundary is the minimum of (cost + position) over a sliding range of
``limit`` ids, kept in a monotone queue; the pairs of boundaries a power of two apart are found at once by
binary search. Each boundary enters and leaves the queue once, so the work is linear.

Documents are packed in the order and partition in which they are read: no shuffle, and a text is
tokenized once. A line is solved whenever ``LINE_TOKENS`` ids are there; a line's end may be padded, which
costs at most ``limit`` in ``LINE_TOKENS`` ids. Sequence ids join the partition and a counter, so a task
that runs again gives the same ids.

Defined results: null and empty texts are documents of the end id alone; repeated rows are packed as
often as they occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import TOKEN_BYTES, byte_chunks, map_text
from factweave.llm.tokenizing import pieces_for, read_ranks

LINE_TOKENS = 1 << 20
SENTENCE_CUT, HARD_CUT = 6.0, 24.0   # penalties in tokens of padding
SEQUENCE_COST = 32.0                 # a sequence more, in tokens of padding
HARD_STEP = 256
_ENDS = (b".", b"!", b"?", b"\n")


def sentence_ends(path: str, ranks_path: str | None = None, size: int = 1 << 17) -> np.ndarray:
    """For every id whether its token closes a sentence or a line."""
    ends = np.zeros(size, bool)
    if ranks_path:
        tokens = read_ranks(ranks_path).items()
    else:
        with open(path, encoding="utf-8") as f:  # in a byte-level vocabulary Ċ is the line feed
            tokens = ((t.replace("Ċ", "\n").encode(), i) for t, i in json.load(f)["model"]["vocab"].items())
    for token, i in tokens:
        if token.endswith(_ENDS):
            ends[i] = True
    return ends


def boundaries(line: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cut positions of a line (0 and its end included) and the penalty of cutting there."""
    n = len(line)
    kind = np.full(n + 1, np.inf)
    kind[1:][ends[line]] = SENTENCE_CUT
    kind[doc_ends] = 0.0
    kind[0] = 0.0
    soft = np.flatnonzero(np.isfinite(kind))
    gap = np.diff(soft)
    for k in np.flatnonzero(gap > HARD_STEP):
        a, b = soft[k], soft[k + 1]
        before = soft[np.searchsorted(soft, a - limit):k + 1]
        full = (before[:, None] + limit * np.arange(1, (b - a) // limit + 2)[None, :]).ravel()
        kind[full[(full > a) & (full < b)]] = HARD_CUT
        kind[np.arange(a + HARD_STEP, b, HARD_STEP)] = HARD_CUT
    at = np.flatnonzero(np.isfinite(kind))
    return at, kind[at]


def power_pairs(at: np.ndarray, limit: int) -> tuple[list[int], list[int]]:
    """(j, k) of all boundaries whose distance at[j] - at[k] is a power of two up to ``limit``, by j."""
    late, early = [], []
    for size in (1 << e for e in range(limit.bit_length())):
        k = np.searchsorted(at, at - size)
        j = np.flatnonzero(at[k] == at - size)
        late.append(j)
        early.append(k[j])
    late, early = np.concatenate(late), np.concatenate(early)
    order = np.argsort(late, kind="stable")
    return late[order].tolist(), early[order].tolist()


def best_cuts(at: np.ndarray, penalty: np.ndarray, limit: int) -> list[int]:
    """Cut positions (first 0, last the end) with the smallest padding plus penalties plus cost of sequences."""
    position, pen = at.tolist(), penalty.tolist()
    n = len(position)
    cost, back = [0.0] * n, [0] * n
    late, early = power_pairs(at, limit)
    late.append(n)
    pair = 0
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # (cost + position, boundary), increasing
    for j in range(1, n):
        p = position[j]
        while position[queue[0][1]] < p - limit:
            queue.popleft()
        i = queue[0][1]
        value = cost[i] + limit - (p - position[i])
        while late[pair] == j:
            k = early[pair]
            if cost[k] < value:
                value, i = cost[k], k
            pair += 1
        value += SEQUENCE_COST + (pen[j] if j < n - 1 else 0.0)
        cost[j], back[j] = value, i
        key = value + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(position[j])
        j = back[j]
    return [0, *reversed(cuts)]


def pack(docs: DataFrame, tokenizer_path: str, limit: int = 2048, end_id: int = 1, with_ids: bool = False,
         ranks_path: str | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, padding);
    with ``with_ids`` also ``ids``. The pieces of a sequence, by offset, are its tokens without gaps. ``ranks_path``: the
    tokenizer's vocabulary as a rank file, for speed (see ``tokenizing``)."""
    def run(batches):
        encoder, ends = pieces_for(tokenizer_path, False, ranks_path), sentence_ends(tokenizer_path, ranks_path)
        first = TaskContext.get().partitionId() << 40
        line, names, tokens = [], [], 0

        def solve():
            nonlocal first
            sizes = np.array([len(x) for x in line], np.int64)
            doc_end = np.cumsum(sizes)
            doc_start = doc_end - sizes
            ids = np.concatenate(line)
            cuts = np.array(best_cuts(*boundaries(ids, doc_end, ends, limit), limit))
            edges = np.union1d(cuts, doc_end)          # piece borders: every cut and every document end
            a, b = np.concatenate([[0], edges[edges > 0][:-1]]).astype(np.int64), edges[edges > 0]
            doc = np.searchsorted(doc_end, a, side="right")
            seq = np.searchsorted(cuts, a, side="right") - 1
            long = (cuts[1:] - cuts[:-1])[seq]
            raw = ids.astype("<u4").tobytes()
            crc = np.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(a.tolist(), b.tolist())], np.int64)
            padding = np.where(long & (long - 1) == 0, 0, limit - long)
            out = [pa.array(names, pa.int64()).take(pa.array(doc)), a - doc_start[doc], b - a, crc, sizes[doc], first + seq, a - cuts[seq], long, padding]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.append(a, b[-1]), pa.int32()), pa.array(ids.astype(np.int32))))
            first += len(cuts) - 1
            return out

        for rows, texts in byte_chunks(batches, "text", TOKEN_BYTES):
            for name, packed in zip(rows.column(0).to_pylist(), encoder.ids(texts)):
                ids = np.frombuffer(packed, "<u4")
                line.append(np.append(ids, np.uint32(end_id)))
                names.append(name)
                tokens += len(ids) + 1
                if tokens >= LINE_TOKENS:
                    yield solve()
                    line, names, tokens = [], [], 0
        if line:
            yield solve()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padding long"
    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
                    schema + (", ids array<int>" if with_ids else ""))
