"""Substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words of one document; a word goes if a window covering it also
starts in a document with a smaller id, judged on the input.

1. *Recurring phrases.* Winnowing picks from every window the ``PHRASE``-word phrase with the smallest
   hash. The choice depends on the window alone, so a window shared by two documents gives both the
   same phrase. Phrases are counted over documents (a partial aggregation); those of one document only
   cannot belong to a shared window. About one phrase in 21 words travels. Texts that are equal word
   by word are one class: its smallest id stands for it, and all other copies are removed whole.
2. *Automata.* Documents that hold a recurring phrase (the others provably hold no shared window) are
   joined with their phrases and stored. Each Arrow batch of them is a shard: its phrases are compiled
   into an Aho-Corasick automaton over word numbers (pyahocorasick), and its documents stream through
   it, so every occurrence is located and an automaton never grows with the corpus.
3. *Confirmation.* Windows around the occurrences are identified by 96 hash bits of their word sequence;
   the smallest document per window comes from a partial aggregation, and a join marks the windows
   that start earlier. A window common to a third of all documents is aggregated before the shuffle,
   and adaptive execution splits its side of the join. Covered words are then dropped per document.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; equal
ids are one document (windows are compared across different ids only), with one result row per input
row; rows with a null id lose nothing and remove nothing; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import byte_chunks, map_text, stored

PHRASE = 8
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the rolling hashes
_NOTHING = hashlib.sha256(b"").hexdigest()


def word_hashes(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in words], dtype=np.uint64)


def rolling(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every ``width`` consecutive values, built by doubling."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, part, size = None, 0, h, 1
    with np.errstate(over="ignore"):
        for bit in range(width.bit_length()):
            if width >> bit & 1:
                piece = part[done:done + n]
                out = piece if out is None else out * np.uint64(pow(base, size, 1 << 64)) + piece
                done += size
            if width >> (bit + 1):
                part = part[:-size] * np.uint64(pow(base, size, 1 << 64)) + part[size:]
                size *= 2
    return out


def phrase_hashes(h: np.ndarray) -> np.ndarray:
    """A well-mixed hash of every phrase, in order of position."""
    p = rolling(h, PHRASE, _BASES[0])
    p = (p ^ (p >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return p ^ (p >> np.uint64(29))


def window_phrases(h: np.ndarray, window: int) -> np.ndarray:
    """The smallest phrase hash of every window."""
    low, reach, span = phrase_hashes(h), 1, window - PHRASE + 1
    n = len(h) - window + 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return np.minimum(low[:n], low[span - reach:span - reach + n])


def _info(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, sha256 of all words, phrases picked from its windows)."""
    def run(batches):
        for rows, texts in byte_chunks(batches, "text"):
            n, sha, phrases = [], [], []
            for t in texts:
                words = t.split()
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                phrases.append(np.unique(window_phrases(word_hashes(words), window)).view(np.int64) if len(words) >= window else [])
            yield rows.column(0), n, sha, phrases

    return map_text(docs, run, "doc_id long, n_words long, sha256 string, phrases array<long>")


def _occurrences(docs: list[tuple[list[bytes], np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Start positions of the shard's recurring phrases in each of its documents: (words, phrase hashes, recurring hashes)."""
    import ahocorasick
    numbers: dict[bytes, int] = {}
    coded = [tuple(numbers.setdefault(w, len(numbers)) for w in words) for words, _, _ in docs]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for code, (_, hashes, recurring) in zip(coded, docs):
        for p in np.flatnonzero(np.isin(hashes, recurring)).tolist():
            automaton.add_word(code[p:p + PHRASE], 1)
    if not len(automaton):
        return [np.zeros(0, np.int64) for _ in docs]
    automaton.make_automaton()
    return [np.fromiter((end for end, _ in automaton.iter(code)), np.int64) - (PHRASE - 1) for code in coded]


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(w1, w2, doc_id, at): windows around located phrases; ``at`` holds a text tag and the start position."""
    def run(batches):
        for rows, raw in byte_chunks(batches, "text"):
            ids, shas, recurring = rows.column(0).to_numpy(), rows.column(1).to_pylist(), rows.column(3)
            words = [t.split() for t in raw]
            hashes = [word_hashes(w) for w in words]
            # a document with repeated ids was joined to the phrases of each of its texts: only its own count
            own = [hashlib.sha256(b" ".join(w)).hexdigest() == s for w, s in zip(words, shas)]
            phrases = [recurring[i].values.to_numpy().view(np.uint64) for i in range(len(words))]
            found = _occurrences([(w, phrase_hashes(h), p) for w, h, p in zip(words, hashes, phrases)])
            for i, starts in enumerate(found):
                n = len(words[i]) - window + 1
                if not own[i] or n <= 0 or not len(starts):
                    continue
                edge = np.zeros(n + 1, np.int64)  # windows that contain an occurrence
                np.add.at(edge, np.clip(starts - (window - PHRASE), 0, n), 1)
                np.add.at(edge, np.clip(starts + 1, 0, n), -1)
                at = np.flatnonzero((np.cumsum(edge[:n]) > 0) & np.isin(window_phrases(hashes[i], window), phrases[i]))
                if len(at):
                    w1 = rolling(hashes[i], window, _BASES[0])[at].view(np.int64)
                    w2 = (rolling(hashes[i], window, _BASES[1])[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    yield pa.array(w1), pa.array(w2), pa.array(np.full(len(at), ids[i])), pa.array(at + (int(shas[i][:7], 16) << 32))

    return map_text(texts, run, "w1 long, w2 int, doc_id long, at long")


def _kept(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, sha256, n_removed, kept_sha256, kept): ``texts`` has the starts of the windows to remove."""
    def run(batches):
        for rows, raw in byte_chunks(batches, "text"):
            ids, shas, starts, out = rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(3), []
            for i, t in enumerate(raw):
                words = t.split()
                if hashlib.sha256(b" ".join(words)).hexdigest() != shas[i]:
                    continue  # another text with this id
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.unique(starts[i].values.to_numpy())
                edge[at] += 1
                edge[at + window] -= 1
                keep = np.cumsum(edge[:-1]) == 0
                left = b" ".join([w for w, k in zip(words, keep.tolist()) if k])
                out.append((ids[i], shas[i], int(len(words) - keep.sum()), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace")))
            if out:
                yield list(zip(*out))

    return map_text(texts, run, "doc_id long, sha256 string, n_removed long, kept_sha256 string, kept string")


def dedup_substrings(docs: DataFrame, window: int = 50, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document; with ``with_text`` also ``kept``: the words left of a
    document that lost some (null: the document is unchanged)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    info = stored(_info(docs, window))
    classes = stored(info.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull()).groupBy("sha256")
                     .agg(F.min("doc_id").alias("least"), F.first("phrases").alias("phrases")))
    phrases = classes.select("sha256", "least", F.explode("phrases").alias("phrase"))
    recurring = stored(phrases.groupBy("phrase").agg(F.min("least").alias("lo"), F.max("least").alias("hi")).filter("lo < hi").select("phrase"))
    involved = phrases.join(recurring, "phrase").groupBy("least", "sha256").agg(F.collect_list("phrase").alias("recurring"))
    texts = stored(docs.join(involved.withColumnRenamed("least", "doc_id"), "doc_id").select("doc_id", "sha256", "text", "recurring"))
    windows = stored(_windows(texts, window))
    first = stored(windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                   .filter("first < last").select("w1", "w2", "first"))
    tag = F.shiftright("at", 32)
    starts = windows.join(first, ["w1", "w2"]).filter(F.col("doc_id") > F.col("first")) \
        .groupBy("doc_id", tag.alias("tag")).agg(F.collect_list(F.col("at").bitwiseAND((1 << 32) - 1)).alias("starts"))
    own = texts.select("doc_id", "sha256", "text", F.conv(F.substring("sha256", 1, 7), 16, 10).cast("long").alias("tag"))
    cut = _kept(own.join(starts, ["doc_id", "tag"]).select("doc_id", "sha256", "text", "starts"), window)
    if not with_text:
        cut = cut.drop("kept")
    cut = stored(cut.dropDuplicates(["doc_id", "sha256"]))
    copy = F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))
    out = info.drop("phrases").join(classes.select("sha256", "least"), "sha256", "left").join(cut, ["doc_id", "sha256"], "left")
    columns = [F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
               F.when(copy, F.lit(_NOTHING)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256")]
    if with_text:
        columns.append(F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"))
    return out.select("doc_id", "n_words", *columns)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, len(words) AS n, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM d),
win AS (
  SELECT doc_id, pos, word, n, CASE WHEN pos <= n - 49 THEN md5(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS h FROM w
),
first AS (SELECT h, min(doc_id) AS least FROM win WHERE h IS NOT NULL GROUP BY h),
gone AS (
  SELECT win.doc_id, pos, word, max(CASE WHEN least < win.doc_id THEN 1 ELSE 0 END) OVER (
    PARTITION BY win.doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS removed
  FROM win LEFT JOIN first ON win.h = first.h
),
kept AS (
  SELECT doc_id, CAST(sum(removed) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE removed = 0) AS left_words
  FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_words, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
