"""Plain versions of the operators, one row or one pair at a time."""

import hashlib
import math
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


class Groups:
    """Union-find over positions."""

    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, i):
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def tie(self, i, j):
        self.parent[self.find(i)] = self.find(j)

    def least(self, names):
        low = {}
        for i, x in enumerate(names):
            if x is not None:
                low[self.find(i)] = min(low.get(self.find(i), x), x)
        return [None if x is None else low[self.find(i)] for i, x in enumerate(names)]


def base_spans(text):
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: s[1])


def top_k(data, k, is_query, scale=256):
    v = {}
    for i, x in data:
        if i is not None and x and all(a is not None and math.isfinite(a) for a in x):
            q = [math.floor(scale * a) for a in x]
            v[i] = min(v.get(i, q), q)
    out = []
    for i in filter(is_query, v):
        scored = sorted((-sum(a * b for a, b in zip(v[i], p)), j) for j, p in v.items() if j != i and len(p) == len(v[i]))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def substrings(data, window):
    words = [(i, WORD.findall(t or "")) for i, t in data]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def source_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        goal = {s: 2 * sizes[s] if s in full else rest * weight[s] / total for s in names}
        over = {s for s in names if s not in full and goal[s] > 2 * sizes[s]}
        if not over:
            return goal
        full |= over


def simhash(data, shingle=4, radius=4):
    prints = []
    for _, t in data:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        s = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    f, g = np.array(prints, dtype=np.uint64), Groups(len(data))
    for i, (d, _) in enumerate(data):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius) if d is not None else ():
            if data[j][0] is not None:
                g.tie(i, int(j))
    least = g.least([d for d, _ in data])
    return sorted([(d, format(p, "016x"), c) for (d, _), p, c in zip(data, prints, least)], key=repr)


def cosine_groups(data, threshold=0.98):
    """data: (id, label, vector)."""
    ok = [i for i, (v, lab, x) in enumerate(data) if v is not None and lab is not None and x and any(x)
          and all(a is not None and math.isfinite(a) for a in x)]
    g, links, by = Groups(len(data)), [0] * len(data), {}
    for i in ok:
        by.setdefault((data[i][1], len(data[i][2])), []).append(i)
    for at in by.values():
        x = np.array([data[i][2] for i in at], float)
        norm = np.linalg.norm(x, axis=1)
        for a, b in zip(*np.nonzero(x @ x.T / norm[:, None] / norm >= threshold)):
            if a != b:
                links[at[a]] += 1
                g.tie(at[a], at[b])
    least = g.least([v for v, _, _ in data])
    return sorted([(v, n, c, None if v is None else v == c) for (v, _, _), n, c in zip(data, links, least)], key=repr)
