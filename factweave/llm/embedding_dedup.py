"""Embedding near-dedup with randomised-rotation binary codes and stored correction factors.

Vectors are compared within a label, by cosine. Equal vectors of a label are one class (its smallest
id stands for it, its size is carried), so groups of copies never meet each other.

Codes: a fixed random rotation turns a unit vector o into o'; its code is sign(o') / sqrt(d), its
correction factor f = <o', code>. For a unit vector q the estimate <code(o), q'> / f is unbiased over the
rotation, and for a pair of cosine c it errs by at most sqrt(1 - c^2) * sqrt(1 - f^2) / f (Cauchy-Schwarz on
the part of q orthogonal to o). Pairs whose estimate falls short of the threshold by more than that
bound cannot link; all others are recomputed exactly in double precision from the vectors themselves.

Candidates: the rotated components are cut into ``bands`` of ``bits``; the signs of a band are a cell. A
pair within the threshold is at squared distance at most t^2 = 2 - 2c, and in some band at most t^2 / bands.
If the sign of component i differs, (|x_i| + |y_i|)^2 counts towards it, so in that band the squares of one
vector's flipped components sum to at most t^2 / (2 bands). Every vector therefore visits, beside its own
cell of a band, all cells that it reaches by flipping components of at most that total, and every linked
pair meets in the home cell of one of the two: nothing is missed. A pair that meets more than once counts
in the first band and the smaller cell only, decided from integers that travel with the rows. ``bits``
grows with the logarithm of the largest label, so that a cell holds about ``TARGET`` vectors.

A cell of over ``BLOCK`` vectors is dealt into blocks and each two blocks meet in a task of their own
(the table of such cells is stored first). A task emits for each vector the links it found and a root
of its spanning forest: never pairs. Counts are summed; components come from distributed star
contraction in the shared folder.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows
with a null label or id, link with nothing (0 links, their own component); vectors of different
dimension do not link; a repeated row is one more vector with the same id (an id
stands for one vector: rows of one id with different vectors share their links); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import components, ship, stored
from factweave.llm.vectors import group_runs, matrix, usable

BLOCK = 2048
TARGET = 4096       # vectors a cell should hold on average
_ROTATIONS: dict[int, np.ndarray] = {}
_SLACK = 1e-9
UNIT = 1 << 40      # costs of flips are integers: squares in this unit, rounded down


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation: the orthogonal factor of a seeded Gaussian matrix."""
    if dim not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(64 + dim).normal(size=(dim, dim)))
        _ROTATIONS[dim] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim]


def flip_budget(threshold: float, bands: int) -> int:
    """A band's share of half of the squared distance of a pair at the threshold, (2 - 2c) / 2, in ``UNIT``."""
    return math.ceil((1 - threshold + _SLACK) / bands * UNIT)


def layout(bits: int, dim: int) -> tuple[int, int]:
    """(bands, bits of a band): one band while cells are few, else four, within 62 signs and the dimension."""
    bands = 1 if bits <= 3 or dim < 16 else 4
    return bands, max(1, min(bits, dim // bands, 62 // bands))


def flips(cost: list[int], budget: int) -> list[int]:
    """Bit sets (as integers, the empty one first) whose costs sum to at most ``budget``."""
    order = sorted(range(len(cost)), key=cost.__getitem__)
    out, open_sets = [], [(0, 0, 0)]  # bits, total, next place in order
    while open_sets:
        bits, total, at = open_sets.pop()
        out.append(bits)
        for j in range(at, len(order)):
            more = total + cost[order[j]]
            if more > budget:
                break
            open_sets.append((bits | 1 << order[j], more, j + 1))
    return out


def _visits(classes: DataFrame, threshold: float, bits: int) -> DataFrame:
    """(label, dim, band, cell, home, cost, rep, size, v): every class in its home cell and the cells it visits, in each band.
    ``home`` holds the signs of all bands, ``cost`` the squares of their components."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part.column("v"), dim).astype(np.float64)
                x /= np.abs(x).max(axis=1)[:, None]
                x = (x / np.linalg.norm(x, axis=1)[:, None]) @ rotation(dim).T
                bands, k = layout(bits, dim)
                budget = flip_budget(threshold, bands)
                cost = np.floor(x[:, :bands * k] ** 2 * UNIT).astype(np.int64)
                home = ((x[:, :bands * k] >= 0).astype(np.int64) << np.arange(bands * k)).sum(axis=1)
                for band, start in itertools.product(range(bands), range(0, part.num_rows, 512)):
                    sets = [flips(c, budget) for c in cost[start:start + 512, band * k:(band + 1) * k].tolist()]
                    row = np.repeat(np.arange(start, start + len(sets)), [len(s) for s in sets])
                    cell = (home[row] >> band * k & (1 << k) - 1) ^ np.array([b for s in sets for b in s], np.int64)
                    take = part.take(pa.array(row))
                    raw = [c.tobytes() for c in cost[start:start + 512]]
                    yield pa.RecordBatch.from_arrays(
                        [take.column("label"), take.column("dim"), pa.array(np.full(len(row), band, np.int32)), pa.array(cell), pa.array(home[row]),
                         pa.array([raw[i - start] for i in row.tolist()], pa.binary()), take.column("rep"), take.column("size"), take.column("v")],
                        names=["label", "dim", "band", "cell", "home", "cost", "rep", "size", "v"])

    label, vector = classes.schema["label"].dataType.simpleString(), classes.schema["v"].dataType.simpleString()
    return classes.select("label", "dim", "rep", "size", "v").mapInArrow(run, f"label {label}, dim int, band int, cell long, home long, cost binary, rep long, size long, v {vector}")


def linked_pairs(v: np.ndarray, home: np.ndarray, cost: np.ndarray, block: np.ndarray, band: int, cell: int, tile: tuple[int, int],
                 threshold: float, bits: int):
    """Indices (i, j) of the linked pairs this tile of this cell owns."""
    dim = v.shape[1]
    bands, k = layout(bits, dim)
    budget = flip_budget(threshold, bands)
    all_homes, home = home, home >> band * k & (1 << k) - 1
    x = v.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    rotated = x @ rotation(dim).T
    code = np.where(rotated >= 0, 1.0, -1.0) / math.sqrt(dim)
    factor = np.einsum("ij,ij->i", rotated, code)
    at_home = np.flatnonzero(home == cell)
    bound = math.sqrt(max(0.0, 1 - threshold ** 2)) * np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor + _SLACK
    left, right = [], []
    for start in range(0, len(at_home), 256):
        o = at_home[start:start + 256]
        estimate = (code[o] @ rotated.T) / factor[o][:, None]
        a, b = np.nonzero(estimate >= (threshold - bound[o])[:, None])
        a = o[a]
        once = (a != b) & ((home[b] != cell) | (a < b))                         # two at home: seen from one side
        once &= (np.minimum(block[a], block[b]) == tile[0]) & (np.maximum(block[a], block[b]) == tile[1])
        a, b = a[once], b[once]
        for i in range(0, len(a), 1 << 15):
            p, q = a[i:i + (1 << 15)], b[i:i + (1 << 15)]
            cosine = np.einsum("ij,ij->i", x[p], x[q])
            near = cosine >= threshold - 1e-12
            p, q = p[near], q[near]
            exact = _cosine(v[p].astype(np.float64), v[q].astype(np.float64)) >= threshold
            left.append(p[exact])
            right.append(q[exact])
    a, b = (np.concatenate(s) if s else np.zeros(0, int) for s in (left, right))
    # a is at home here; if b is not, the pair also meets in b's home when a can visit it: the smaller cell owns it
    differ = ((all_homes[a] ^ all_homes[b])[:, None] >> np.arange(bands * k) & 1).reshape(-1, bands, k)
    reach = [(differ * cost[i].reshape(-1, bands, k)).sum(axis=2) <= budget for i in (a, b)]  # (pairs, bands): whether i visits the other
    mine = (home[b] == cell) | ~reach[0][:, band] | (home[a] < home[b])
    earlier = (reach[0] | reach[1])[:, :band].any(axis=1)
    return a[mine & ~earlier], b[mine & ~earlier]


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    dot = np.einsum("ij,ij->i", x, y)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    parent = list(range(n))
    for i, j in zip(a.tolist(), b.tolist()):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        while parent[j] != j:
            parent[j] = j = parent[parent[j]]
        parent[max(i, j)] = min(i, j)
    for i in range(n):
        parent[i] = parent[parent[i]]
    return parent


def _found(visits: DataFrame, threshold: float, block: int, bits: int) -> DataFrame:
    """(rep, links, root): per tile, the links of each class that has some and a root that connects it."""
    cells = ["label", "dim", "band", "cell"]
    big = visits.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))
    big = stored(big.select(*cells, F.ceil(F.col("n") / block).cast("int").alias("blocks")).filter("blocks > 1"))
    mine = F.coalesce(F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int"), F.lit(0))
    dealt = visits.join(big, cells, "left").withColumn("block", mine)
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = dealt.withColumn("other", other).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    group = [*cells, "lo", "hi"]
    tiles = tiles.select(*group, "block", "home", "cost", "rep", "size", "v").repartition(*group).sortWithinPartitions(*group)

    def run(batches):
        held, group_key = [], None

        def close():
            t = pa.Table.from_batches(held).combine_chunks()
            if t.num_rows < 2:
                return None
            dim, band, cell, lo, hi = (int(t.column(c)[0].as_py()) for c in ("dim", "band", "cell", "lo", "hi"))
            v = matrix(t.column("v").combine_chunks(), dim)
            cost = np.array([np.frombuffer(c, np.int64) for c in t.column("cost").to_pylist()])
            home, size, rep = (t.column(c).to_numpy() for c in ("home", "size", "rep"))
            a, b = linked_pairs(v, home, cost, t.column("block").to_numpy(), band, cell, (lo, hi), threshold, bits)
            if not len(a):
                return None
            links = np.zeros(len(rep), np.int64)
            np.add.at(links, a, size[b])
            np.add.at(links, b, size[a])
            root = np.array(_roots(len(rep), a, b))
            some = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some]), pa.array(rep[root[some]])], names=["rep", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column("label").dictionary_encode()
            keys = np.stack([label.indices.to_numpy()] + [batch.column(c).to_numpy().astype(np.int64) for c in group[1:]], axis=1)
            for start, end in zip(*group_runs(keys)):
                key = (label.dictionary[int(keys[start][0])].as_py(), *keys[start][1:].tolist())
                if key != group_key:
                    if held and (out := close()) is not None:
                        yield out
                    held, group_key = [], key
                held.append(batch.slice(start, end - start))
        if held and (out := close()) is not None:
            yield out

    return tiles.mapInArrow(run, "rep long, links long, root long")


def embedding_dedup(vectors: DataFrame, threshold: float = 0.98, block: int = BLOCK, bits: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("v"))
    nonzero = F.exists("v", lambda x: x != 0)
    valid = rows.filter(usable("v") & nonzero & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = stored(valid.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size")).withColumn("dim", F.size("v")))
    if bits is None:
        largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
        bits = max(1, math.ceil(math.log2(largest / TARGET)))
    found = stored(_found(stored(_visits(classes, threshold, bits)), threshold, block, bits))
    comp = components(classes.select(F.col("rep").alias("id")).distinct(), found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_class = classes.join(comp.withColumnRenamed("id", "rep"), "rep").join(sums, "rep", "left") \
        .select(F.col("label").alias("l"), F.col("v").alias("w"), "component_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    of_class = stored(of_class)
    out = rows.join(of_class, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      (F.col("vec_id") == component).alias("kept"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS links FROM l GROUP BY a)
SELECT vec_id, coalesce(links, 0) AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c.least, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""
