"""Quality classifier: a byte-level convolutional network in numpy.

The text's UTF-8 bytes are cut into overlapping chunks that cover the whole document. Learned
filters run over every chunk (width 8 bytes, at every offset, ReLU), are max-pooled within the chunk, and
a linear layer turns the pooled activations into a chunk logit. Beside the learned filters stand
box filters over "this byte equals the one ``lag`` bytes before" (lags 2 to 32, max-pooled over
positions and lags), through which repeated words are seen, and how far the chunk is filled. The document's probability is the
sigmoid of a learned mix of the mean and the minimum of its chunk logits, so a document that is
junk in one part only is seen as well as one that is junk throughout.

A filter is stored as four tables over byte pairs, so a convolution is four table look-ups and
three additions per position. Training (Adam, fixed seed) takes a bounded sample of labelled rows:
``SAMPLE_PER_CLASS`` rows per label in hash order, at most ``SAMPLE_CHUNKS`` evenly spread chunks
of each. Scoring covers every chunk of every text in one pass without a shuffle.

Defined results: a null or empty text is scored as one chunk of padding; repeated rows give
repeated rows; an empty table gives an empty result; other columns are not read. Labels that are
null or other than 0 and 1 are not learned from; a document labelled twice counts with its lower
label. Without labelled rows of both classes every score is 1 (nothing is known to be bad).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import byte_chunks, map_text

WIDTH = 8                       # bytes under a filter; filters stand at every offset
CHUNK, STEP = 512, 448          # bytes of a chunk, bytes between two chunks
FILTERS = 24
LAGS = range(2, 33)             # distances at which a byte is compared with an earlier one
BOXES = (16, 40, 120)           # widths of the box filters over those comparisons (multiples of 8)
EXTRA = len(BOXES) + 3          # box filters and three features of the chunk's fill
SAMPLE_PER_CLASS = 1200
SAMPLE_CHUNKS = 16
EPOCHS, RATE = 14, 0.01
PREDICT_AT = 0.3


@dataclass
class Network:
    tables: np.ndarray   # (WIDTH, 256, FILTERS)
    bias: np.ndarray     # (FILTERS,)
    out: np.ndarray      # (FILTERS + EXTRA,)
    mix: np.ndarray      # constant, weight of the mean, weight of the minimum

    def pair_tables(self) -> list[np.ndarray]:
        """Each two neighbouring byte tables as one over byte pairs (first byte is the high one)."""
        return [(self.tables[j][:, None, :] + self.tables[j + 1][None, :, :]).reshape(65536, -1).astype(np.float32)
                for j in range(0, WIDTH, 2)]


def chunked(raw: bytes, most: int | None = None) -> np.ndarray:
    """(chunks, CHUNK) bytes covering ``raw``; zero padding after its end. ``most``: evenly spread chunks only (training)."""
    n = max(1, -(-max(0, len(raw) - CHUNK) // STEP) + 1)
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    starts = np.arange(n) * STEP
    if most and n > most:
        starts = starts[np.linspace(0, n - 1, most).astype(int)]
    return padded[starts[:, None] + np.arange(CHUNK)]


def _pairs(chunks: np.ndarray) -> np.ndarray:
    """Byte pairs at every offset: (chunks, CHUNK - 1)."""
    return (chunks[:, :-1].astype(np.int32) << 8) | chunks[:, 1:]


def _conv(pairs: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """(chunks, positions, FILTERS) before bias and ReLU."""
    positions = pairs.shape[1] - WIDTH + 2
    z = tables[0][pairs[:, :positions]]
    for j in range(1, len(tables)):
        z += tables[j][pairs[:, 2 * j:2 * j + positions]]
    return z


def _repeats(chunks: np.ndarray) -> np.ndarray:
    """(chunks, EXTRA): pooled box filters over equal bytes at some lag, and the chunk's fill."""
    n, cells = len(chunks), CHUNK // 8
    real = chunks != 0
    earlier = np.where(real, chunks, 255)  # padding equals nothing; 255 does not occur in UTF-8
    same = np.zeros((n, CHUNK), np.uint8)
    total = np.zeros((n, cells + 1), np.int32)
    best = np.zeros((n, len(BOXES)), np.float32)
    for lag in LAGS:
        same[:, :lag] = 0
        np.equal(chunks[:, lag:], earlier[:, :-lag], out=same[:, lag:].view(bool))
        # the eight bytes of a cell are added by one multiplication: the sum is in the top byte
        np.cumsum((same.view(np.uint64) * np.uint64(0x0101010101010101)) >> np.uint64(56), axis=1, out=total[:, 1:])
        for k, box in enumerate(BOXES):
            np.maximum(best[:, k], (total[:, box // 8:] - total[:, :-(box // 8)]).max(axis=1) / box, out=best[:, k], casting="unsafe")
    fill = real.mean(axis=1)[:, None]
    return np.concatenate([np.maximum(best - 0.5, 0) * 2, fill, fill < 0.05, fill < 0.2], axis=1).astype(np.float32)


def _document_logit(chunk_logit: np.ndarray, owner: np.ndarray, docs: int, mix: np.ndarray):
    """Logits of documents and, for training, mean, the chunk of the minimum, and chunk counts. ``owner`` is sorted."""
    starts = np.searchsorted(owner, np.arange(docs))
    count = np.bincount(owner, minlength=docs)
    mean = np.add.reduceat(chunk_logit, starts) / count
    low = np.minimum.reduceat(chunk_logit, starts)
    return mix[0] + mix[1] * mean + mix[2] * low, mean, low, starts, count


def score(net: Network, texts: list[bytes], tables: list[np.ndarray], block: int = 256) -> np.ndarray:
    """Probabilities of label 1; chunks are convolved ``block`` at a time, so memory does not depend on the texts."""
    sizes = [max(1, -(-max(0, len(t) - CHUNK) // STEP) + 1) for t in texts]
    owner = np.repeat(np.arange(len(texts)), sizes)
    logits = np.empty(len(owner))
    at, held, held_n = 0, [], 0

    def flush():
        nonlocal at, held, held_n
        chunks = np.concatenate(held)
        for i in range(0, len(chunks), block):
            part = chunks[i:i + block]
            pooled = np.maximum(_conv(_pairs(part), tables).max(axis=1) + net.bias, 0)
            logits[at:at + len(part)] = np.concatenate([pooled, _repeats(part)], axis=1) @ net.out
            at += len(part)
        held, held_n = [], 0

    for t in texts:
        c = chunked(t)
        held.append(c)
        held_n += len(c)
        if held_n >= block:
            flush()
    if held:
        flush()
    z = _document_logit(logits, owner, len(texts), net.mix)[0]
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> Network:
    """Fit the network by Adam on the logistic loss; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  np.concatenate([rng.normal(0, 0.3, FILTERS), np.zeros(EXTRA)]).astype(np.float32), np.array([0.0, 0.5, 0.5], np.float32))
    chunks = [chunked(t, SAMPLE_CHUNKS) for t in texts]
    repeats = [_repeats(c) for c in chunks]
    y = np.asarray(labels, np.float32)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    params = [net.tables, net.bias, net.out, net.mix]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // 48)):
            x = np.concatenate([chunks[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(chunks[i]) for i in batch])
            z = _conv(_pairs(x), [_Pair(net.tables[j], net.tables[j + 1]) for j in range(0, WIDTH, 2)])
            best = z.argmax(axis=1)                                   # (chunks, FILTERS)
            pre = np.take_along_axis(z, best[:, None, :], 1)[:, 0, :] + net.bias
            pooled = np.concatenate([np.maximum(pre, 0), np.concatenate([repeats[i] for i in batch])], axis=1)
            logit = pooled @ net.out
            doc, mean, low, starts, count = _document_logit(logit, owner, len(batch), net.mix)
            d = (1 / (1 + np.exp(-np.clip(doc, -50, 50))) - y[batch]) * weight[batch] / len(batch)
            g_mix = np.array([d.sum(), (d * mean).sum(), (d * low).sum()])
            g_logit = net.mix[1] * (d / count)[owner]
            lowest = np.array([s + logit[s:s + c].argmin() for s, c in zip(starts, count)])
            np.add.at(g_logit, lowest, net.mix[2] * d)
            g_out = pooled.T @ g_logit
            g_pre = np.where(pre > 0, g_logit[:, None] * net.out[:FILTERS], 0).astype(np.float32)
            g_tables = np.zeros_like(net.tables)
            rows, filters = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
            for j in range(WIDTH):
                np.add.at(g_tables[j], (x[rows, best + j], np.broadcast_to(filters, best.shape)), g_pre)
            t += 1
            for p, g, m, v in zip(params, (g_tables, g_pre.sum(0), g_out + 1e-4 * net.out, g_mix), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-7)).astype(p.dtype)
    return net


class _Pair:
    """A table over byte pairs summed on look-up; training changes the tables too often to store them by pair."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.high, self.low = high, low

    def __getitem__(self, pairs: np.ndarray) -> np.ndarray:
        return self.high[pairs >> 8] + self.low[pairs & 255]


def in_training(id_col: str = "doc_id"):
    """Rows labels are learned from: crc32 of the id's text mod 5 is not 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def learn(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Train on the bounded sample; its ids are chosen before any text is read, and only its rows reach the driver."""
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(in_training())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.filter(F.col("quality") == q).orderBy(*order).limit(SAMPLE_PER_CLASS).select("doc_id", "quality") for q in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 x SAMPLE_PER_CLASS rows
    # evenly spread chunks of a long text are all that training sees of it; the cut happens before collecting
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(sample, "doc_id")

    def spread(batches):
        for part, texts in byte_chunks(batches, "text"):
            yield (pa.array([chunked(t, SAMPLE_CHUNKS).tobytes() if len(t) > SAMPLE_CHUNKS * CHUNK else t for t in texts], pa.binary()),
                   part.column(part.schema.get_field_index("quality")).cast(pa.int32()), part.column(part.schema.get_field_index("doc_id")))

    got = sorted(map_text(rows, spread, "text binary, quality int, doc_id long").collect(), key=lambda r: (r.doc_id, bytes(r.text)))
    if len({r.quality for r in got}) < 2:
        return None
    return train([bytes(r.text) for r in got], [r.quality for r in got])


def _scorer(net: Network | None):
    tables = net.pair_tables() if net else []
    return lambda texts: score(net, texts, tables) if net else np.ones(len(texts))


def keep_good(docs: DataFrame, net: Network | None, threshold: float = PREDICT_AT) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores at least ``threshold``."""
    def run(batches):
        scorer = _scorer(net)
        for part, texts in byte_chunks(batches, "text"):
            kept = part.filter(pa.array(scorer(texts) >= threshold))
            yield [kept.column(i) for i in range(kept.num_columns)]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_text(docs, run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = PREDICT_AT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    net = learn(docs, labels)

    def run(batches):
        scorer = _scorer(net)
        for part, texts in byte_chunks(batches, "text"):
            s = scorer(texts)
            yield part.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))

    scored = map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (~in_training()).alias("held_out"), "score", "predicted")
