"""Best-fit packing by minimum bin slack, over the histogram of piece lengths.

1. Tasks tokenize their documents (every document ends with ``end_id``), cut longer ones into pieces of
   ``limit`` ids, and number the pieces of each length within the task. The narrow piece table (no ids, no
   text) is written to the shared folder once: lengths and numbers are fixed from then on, whatever is lost later.
2. How many pieces there are of each length is all that packing needs: at most ``limit`` counts, whatever the
   size of the corpus. Bin by bin, the longest piece left opens the bin and a subset-sum dynamic program over
   the lengths left (a bitset of reachable sums; a length counts as often as pieces of it remain) finds the
   fullest combination that fits with it; of equally full ones the one of longer pieces. The combination is
   removed as often as the counts allow before the next one is sought, so the plan has some thousand
   patterns at most, not one per sequence.
3. A piece's number among all pieces of its length (its number in the task plus the counts of earlier tasks)
   says which copy of which pattern it fills. That look-up is a binary search in the plan, which is bounded
   by ``limit`` and travels with the tasks. No length's pieces meet in one task, however many there are.

Defined results: null and empty texts are documents of the end id alone; repeated rows are packed as often as
they occur; a null id stays null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factweave.llm.common import TOKEN_BYTES, byte_chunks, map_text, stored
from factweave.llm.tokenizing import pieces_for


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """{length: copies} of the fullest combination of at most ``room``; ``lengths`` falls and holds the keys of ``counts``.

    Longer lengths are tried first, and the search ends with the first one that fills the room to the last id.
    """
    if room <= 0:
        return {}
    mask, sums, steps = (1 << room + 1) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        copies = min(counts[length], room // length)
        steps.append((length, copies, sums))
        k, left = 1, copies
        while left:  # copies in binary: 1, 2, 4, ..., rest
            k = min(k, left)
            sums |= sums << length * k & mask
            left -= k
            k *= 2
        if sums >> room:
            break
    total, out = sums.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        used = next(c for c in range(copies + 1) if c * length <= total and before >> total - c * length & 1)
        if used:
            out[length] = used
            total -= used * length
    return out


def patterns(counts: dict[int, int], limit: int) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack over piece counts: [(pieces of each length in one bin, number of such bins)]."""
    counts, out = {k: v for k, v in counts.items() if v}, []
    lengths = sorted(counts, reverse=True)
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        use = fullest(counts, lengths, limit - seed)
        counts[seed] += 1
        use[seed] = use.get(seed, 0) + 1
        times = min(counts[k] // n for k, n in use.items())
        for k, n in use.items():
            counts[k] -= n * times
        out.append((dict(sorted(use.items(), reverse=True)), times))
        if any(not counts[k] for k in use):
            lengths = [k for k in lengths if counts[k]]
    return out


class Slots:
    """For every length the ranges of piece numbers that fill one pattern, sorted for binary search."""

    def __init__(self, counts: dict[int, int], limit: int):
        rows, first, taken = [], 0, dict.fromkeys(counts, 0)
        for use, times in patterns(counts, limit):
            offset = 0
            for length, n in use.items():
                rows.append((length, taken[length], n, first, offset))
                taken[length] += n * times
                offset += n * length
            first += times
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.sequences = first
        self.key, self.number, self.each, self.first, self.offset = table[:, 0] << 44 | table[:, 1], table[:, 1], table[:, 2], table[:, 3], table[:, 4]

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of the pieces with these lengths and numbers among their length."""
        at = np.searchsorted(self.key, length << 44 | number, side="right") - 1
        copy, k = np.divmod(number - self.number[at], self.each[at])
        return self.first[at] + copy, self.offset[at] + k * length


def pieces(docs: DataFrame, tokenizer_path: str, limit: int, end_id: int, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, number): every document in pieces of at most ``limit`` ids;
    ``number`` counts the pieces of a length within the task ``part``."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder, part, seen = pieces_for(tokenizer_path, False, ranks_path), TaskContext.get().partitionId(), [0] * (limit + 1)
        for rows, texts in byte_chunks(batches, "text", TOKEN_BYTES):
            doc, piece, start, length, crc, number = [], [], [], [], [], []
            for i, ids in enumerate(encoder.ids(texts)):
                ids += end
                for k, a in enumerate(range(0, len(ids), 4 * limit)):
                    cut = ids[a:a + 4 * limit]
                    n = len(cut) // 4
                    doc.append(i)
                    piece.append(k)
                    start.append(k * limit)
                    length.append(n)
                    crc.append(zlib.crc32(cut))
                    number.append(seen[n])
                    seen[n] += 1
            yield rows.column(0).take(pa.array(doc)), piece, start, length, crc, [part] * len(doc), number

    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
                    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long")


def pack_min_slack(docs: DataFrame, tokenizer_path: str, limit: int = 4096, end_id: int = 1, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every document's pieces in as few sequences as the method finds."""
    all_pieces = stored(pieces(docs, tokenizer_path, limit, end_id, ranks_path))
    per_part = all_pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``limit`` rows
    slots = Slots(counts, limit)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = all_pieces.join(base, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("number")).alias("number"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                sequence, offset = slots.place(b.column(3).to_numpy(), b.column(5).to_numpy())
                yield *(b.column(i) for i in range(5)), sequence, offset

    return map_text(numbered, run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
