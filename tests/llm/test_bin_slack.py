"""Packing by minimum bin slack: the plan against all combinations, the pieces against the library."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from factweave.llm import bin_slack
from factweave.llm.tokenizing import Pieces
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_fullest_combination_equals_all_combinations():
    rng = random.Random(3)
    for _ in range(300):
        limit = rng.choice([10, 30, 64])
        counts = {rng.randint(1, limit): rng.randint(1, 5) for _ in range(rng.randint(1, 6))}
        room, lengths = rng.randint(0, limit), sorted(counts, reverse=True)
        used = bin_slack.fullest(counts, lengths, room)
        sums = (sum(a * b for a, b in zip(c, lengths)) for c in itertools.product(*[range(counts[k] + 1) for k in lengths]))
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)
        assert all(0 < n <= counts[k] for k, n in used.items())


def test_patterns_use_every_piece_once_and_equal_one_bin_at_a_time():
    rng = random.Random(8)
    for _ in range(60):
        counts = {rng.randint(1, 50): rng.randint(1, 9) for _ in range(rng.randint(0, 12))}
        total = Counter()
        for use, times in bin_slack.patterns(dict(counts), 50):
            assert sum(k * n for k, n in use.items()) <= 50 and times > 0
            total.update({k: n * times for k, n in use.items()})
        assert total == counts
        slots, numbers = bin_slack.Slots(dict(counts), 50), [(k, i) for k, n in counts.items() for i in range(n)]
        if numbers:
            seq, off = slots.place(*np.array(numbers).T)
            check_sequences([(k, s, o) for (k, _), s, o in zip(numbers, seq.tolist(), off.tolist())], 50)
            assert len(set(seq.tolist())) == slots.sequences


def check_sequences(rows, limit):
    """(length, sequence, offset): every sequence is gapless from 0 and no longer than ``limit``."""
    by = defaultdict(list)
    for length, sequence, offset in rows:
        by[sequence].append((offset, length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_pieces_are_the_documents(spark, documents, texts):
    tokenizer = Tokenizer.from_file(PATH)
    for limit, parts in ((4096, 1), (256, 7)):
        rows = bin_slack.pack_min_slack(documents.repartition(parts), PATH, limit=limit).collect()
        assert rows[0].__fields__ == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        want = Counter()
        for i, t in texts:
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
            for k, a in enumerate(range(0, len(ids), limit)):
                cut = ids[a:a + limit]
                want[i, k, a, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        bins = check_sequences([(r.length, r.sequence_id, r.offset) for r in rows], limit)
        least = -(-sum(r.length for r in rows) // limit)
        assert least <= bins <= least * 1.02 + 2
    assert bin_slack.pack_min_slack(documents.limit(0), PATH).count() == 0


def test_a_length_of_a_third_of_all_pieces(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('a b ', 20) ELSE repeat('c ', CAST(id % 97 AS INT)) END AS text")
    got = bin_slack.pack_min_slack(rows.repartition(13), PATH, limit=128).collect()
    assert len(got) == 3000
    bins = check_sequences([(r.length, r.sequence_id, r.offset) for r in got], 128)
    assert bins <= -(-sum(r.length for r in got) // 128) * 1.05


def test_texts_are_cut_and_cached_within_bounds(spark):
    """The word file is recognised, counts stay equal, long runs are cut, long pieces are not kept."""
    encoder = Pieces(PATH, True)
    assert (encoder.cut, encoder.lower, encoder.cut_long) == ("words", True, True)
    assert Pieces(public_tokenizers.path("byte_bpe_50k.json"), True).cut == "spaced"
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    marks = ["a", "B", "1", "2", ".", "'", "'s", "S", "é", "é", "中", " ", "\n", "\x85", "½", "İ", "Σ", "\x1c", "-", "_", "<", ">", "|", "ﬁ", "'LL"]
    odd = ["".join(rng.choices([*marks, "<|endoftext|>"], k=rng.randint(0, 40))) for _ in range(3000)]
    odd += ["".join(rng.choices([x for x in marks if x.strip()], k=20_000)), "ab1." * 9000, "x" * 20_000, "ab1." * 9000 + "<|endoftext|>",
            *(r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect())]
    raw = [t.encode() for t in odd]
    assert encoder.lengths(raw) == [len(e) for e in tokenizer.encode_batch(odd, add_special_tokens=False)]
    assert max(map(len, encoder.pieces(b"ab1." * 9000))) < 5000
    assert max(map(len, encoder.cache)) <= 256 and encoder.held >= sum(map(len, encoder.cache))


def test_the_cache_stops_growing(monkeypatch):
    from factweave.llm import tokenizing
    monkeypatch.setattr(tokenizing, "CACHE_BYTES", 20_000)
    encoder, tokenizer = Pieces(PATH, True), Tokenizer.from_file(PATH)
    for start in range(0, 5000, 500):
        texts = [f"word{i} {i * 7}. Common, words" for i in range(start, start + 500)]
        assert encoder.lengths([t.encode() for t in texts]) == [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert encoder.held <= 20_000 and len(encoder.cache) < 200
