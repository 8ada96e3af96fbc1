"""Substring dedup, packing, mixing and SimHash against plain versions."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factweave.llm import mixing, packing, simhash, substrings
from tests.llm import brute


def test_substrings(spark, documents, texts):
    random.seed(0)
    v = "a b c d e f g h i j k l m n o p".split()
    shared = [" ".join(random.choice(v) for _ in range(n)) for n in (49, 50, 51, 60, 120)]
    data = []
    for _ in range(150):
        t = []
        for _ in range(random.randint(0, 4)):
            t += random.choice(shared).split()[random.choice([0, 0, 0, 1, 5]):] if random.random() < 0.5 else [random.choice(v) for _ in range(random.randint(0, 80))]
        data.append((random.randint(2000, 2120), " ".join(t)))
    data += [(None, shared[4]), (5001, "x " * 500), (5002, "x\n" * 300), (5003, shared[4] + "\n" + shared[4])]
    df = documents.select("doc_id", "text", "size", "key").unionByName(spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'x' AS size", "1 AS key"))
    assert brute.rows(substrings.dedup_substrings(df)) == brute.substrings(texts + data, 50)
    kept = {r.doc_id: r for r in substrings.dedup_substrings(df, with_text=True).filter("doc_id > 5000 AND doc_id < 6000").collect()}
    assert kept[5002].kept == "" and kept[5001].kept is None and kept[5002].n_removed == 300
    assert substrings.dedup_substrings(df.limit(0)).count() == 0


@given(st.lists(st.integers(0, 3), min_size=60, max_size=200), st.integers(9, 40))
@settings(max_examples=60, deadline=None)
def test_window_phrase_is_the_windows_own(letters, window):
    h = substrings.word_hashes([str(x).encode() for x in letters])
    all_phrases = substrings.phrase_hashes(h)
    got = substrings.window_phrases(h, window)
    assert got.tolist() == [min(all_phrases[i:i + window - substrings.PHRASE + 1]) for i in range(len(letters) - window + 1)]
    w = substrings.rolling(h, window, substrings._BASES[1])
    keys = [tuple(letters[i:i + window]) for i in range(len(letters) - window + 1)]
    assert len(w) == len(keys) and len(set(w.tolist())) == len(set(keys))


@given(st.lists(st.tuples(st.integers(1, 32), st.sampled_from([0.0, 2.0, 6.0])), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_cuts_are_optimal(steps):
    limit, at, pen = 32, [0], [0.0]
    for size, p in steps:
        at.append(at[-1] + size)
        pen.append(p)
    price = lambda size: packing.SEQUENCE_COST + (0 if size & (size - 1) == 0 else limit - size)
    best = [0.0] + [1e9] * (len(at) - 1)
    for j in range(1, len(at)):
        best[j] = min(best[i] + price(at[j] - at[i]) + (pen[j] if j < len(at) - 1 else 0) for i in range(j) if at[j] - at[i] <= limit)
    cuts = packing.best_cuts(np.array(at), np.array(pen), limit)
    cost = sum(price(b - a) + (dict(zip(at, pen))[b] if b != at[-1] else 0) for a, b in zip(cuts, cuts[1:]))
    assert cuts[0] == 0 and cuts[-1] == at[-1] and abs(cost - best[-1]) < 1e-9


def test_hard_points_leave_full_sequences_possible():
    """Behind short documents, a sentence far longer than the limit may be cut where every sequence but the last is full."""
    for first in (37, 300, 1999):
        n = first + 9000
        at, pen = packing.boundaries(np.full(n, 3), np.array([first, n]), np.zeros(10, bool), 2048)
        full = [*range(0, n, 2048), n]
        assert set(full) <= set(at.tolist())

        def price(cuts):
            sizes, there = np.diff(cuts).tolist(), dict(zip(at.tolist(), pen.tolist()))
            return sum(packing.SEQUENCE_COST + (0 if x & (x - 1) == 0 else 2048 - x) for x in sizes) + sum(there[c] for c in cuts[1:-1])

        cuts = packing.best_cuts(at, pen, 2048)
        assert cuts[0] == 0 and cuts[-1] == n and max(np.diff(cuts)) <= 2048 and price(cuts) <= price(full)


def test_packing_round_trip(spark, documents, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(documents, path, with_ids=True, ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    library = Tokenizer.from_file(path)
    want = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in texts)
    docs, sequences = {}, {}
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        sequences.setdefault(p.sequence_id, []).append(p)
    order = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))  # documents follow each other in a partition's line
    got, open_ids = [], []
    for p in order:
        assert p.start == len(open_ids)
        open_ids += p.ids
        if len(open_ids) == p.doc_tokens:
            got.append(tuple(open_ids))
            open_ids = []
    assert not open_ids and sorted(got) == want
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and {p.sequence_tokens for p in s} == {at} and s[0].padding == (0 if at & (at - 1) == 0 else 2048 - at)
    total = sum(map(len, want))
    assert sum(s[0].padding for s in sequences.values()) < 0.03 * total
    assert packing.pack(documents.limit(0), path).count() == 0 and len(docs) == 0


def check_mix(df):
    data = [(r.doc_id, r.source, len(brute.WORD.findall(r.text or ""))) for r in df.select("doc_id", "source", "text").collect()]
    sizes = {}
    for _, s, n in data:
        sizes[s] = sizes.get(s, 0) + n
    goal, source, got = brute.source_targets(sizes), {d: s for d, s, _ in data}, {}
    rows = mixing.mix_sizes(df).collect()
    assert sorted([(r.doc_id, r.size) for r in rows], key=repr) == sorted([(d, n) for d, _, n in data], key=repr)
    for r in rows:
        s = source[r.doc_id]
        got[s] = got.get(s, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[s] and abs(r.target - goal[s]) <= 1e-6 * max(1, goal[s])
    return goal, got, rows


def test_mixing(spark, documents):
    goal, got, rows = check_mix(documents)
    assert all(abs(got[s] - goal[s]) <= 1 for s in goal if s != "src0")
    assert abs(got["src0"] - goal["src0"]) <= 1 + 3  # a row that occurs twice is taken alike
    again = mixing.mix_sizes(documents.repartition(7)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)
    mixed = mixing.mix(documents)
    assert mixed.schema.simpleString() == documents.schema.simpleString()
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(brute.WORD.findall(r.text))
    taken = {}
    for r in rows:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert words == {d: n for d, n in taken.items() if n}
    assert mixing.mix_sizes(documents.limit(0)).count() == 0 and mixing.mix(documents.limit(0)).count() == 0


def test_mixing_of_single_and_empty_sources(spark):
    check_mix(spark.createDataFrame([(1, "a b c", None), (2, "", None), (4, "a " * 500, "x"), (7, "b " * 5, "Z"), (9, "", "w"), (10, None, "v")],
                                    "doc_id long, text string, source string"))


def test_mixing_shares_copies_among_repeated_rows(spark):
    data = [(1, "a " * 100, "many")] * 1000 + [(None, f"{i} " * 40, "none") for i in range(700)] + [(None, f"{i} " * 30, "none") for i in range(3)]
    data += [(10 + i, "b " * (50 + i), "other") for i in range(300)] + [(2, "c " * 1000, "z")] * 3 + [(None, None, "z")] * 5
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal, planned, mixed, per_row = brute.source_targets(sizes), {}, {}, {}
    of = {1: "many", None: "none", 2: "z"}
    for r in mixing.mix_sizes(df).collect():
        s = "z" if not r.size else of.get(r.doc_id, "other")
        planned[s] = planned.get(s, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
        per_row.setdefault((s, r.doc_id, r.size), []).append(r.taken)
    for r in mixing.mix(df).collect():
        mixed[r.source] = mixed.get(r.source, 0) + len(r.text.split())
    for s in goal:
        assert abs(planned[s] - goal[s]) <= 1 and mixed.get(s, 0) == planned[s], (s, planned[s], goal[s], mixed.get(s))
    for (_, _, size), each in per_row.items():
        assert max(each) - min(each) <= size


@pytest.mark.parametrize("block", [4096, 32])
def test_simhash(spark, documents, texts, block):
    random.seed(0)
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega ".split() * 8
    data = []
    for i in range(250):
        w = list(base)
        for _ in range(random.randint(0, 4)):
            w[random.randrange(len(w))] = random.choice("abcdefgh") * 3
        data.append((100_000 + i, " ".join(w)))
    df = documents.select("doc_id", "text", "fp").unionByName(spark.createDataFrame(data, "doc_id long, text string").withColumn("fp", F.lit("y")))
    want = brute.simhash(texts + data)
    assert brute.rows(simhash.simhash_components(df, block=block)) == want
    if block == 32:
        kept = {r.doc_id for r in simhash.near_dedup(df).collect()}
        assert kept == {d for d, _, c in want if d == c}
        assert simhash.simhash_components(df.limit(0)).count() == 0


def test_near_dedup_keeps_one_row_of_each_group(spark):
    random.seed(1)
    text = lambda: " ".join("".join(random.choices("abcdefghij", k=6)) for _ in range(200))
    five, own, odd, twice, both = (text() for _ in range(5))
    near = own + " x"
    data = [(5, five), (7, five), (7, own), (8, near), (9, odd), (3, twice), (3, twice), (3, twice), (4, twice), (None, odd), (None, odd), (20, both), (20, both + " y"), (21, both)]
    prints = [simhash.fingerprint(t.encode(), 4) for t in (own, near, both, both + " y")]
    assert (prints[0] ^ prints[1]).bit_count() <= 4 and (prints[2] ^ prints[3]).bit_count() <= 4
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS fp", "'z' AS c1", "length(text) AS n_chars").repartition(3)
    out = simhash.near_dedup(df)
    assert out.columns == df.columns
    got = sorted([(r.doc_id, r.text) for r in out.collect()], key=repr)
    least = [g for g in got if g[0] == 20]
    assert len(least) == 1 and least[0][1].startswith(both)
    assert sorted([g for g in got if g[0] != 20], key=repr) == sorted([(5, five), (7, own), (9, odd), (3, twice), (None, odd), (None, odd)], key=repr)


def test_masks_cover_every_difference():
    import itertools
    kept = simhash.masks(2, bits=16)
    for n in (1, 2):
        for bits in itertools.combinations(range(16), n):
            assert any(not any(m >> b & 1 for b in bits) for m in kept)
    assert len(simhash.masks(4)) == 31 and all(20 <= bin(m).count("1") <= 44 for m in simhash.masks(4))
