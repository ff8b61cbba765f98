"""Plain statements of what the corpus operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n == 1


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        self.up[self.find(a)] = self.find(b)

    def least(self, ids):
        by = defaultdict(list)
        for i, d in enumerate(ids):
            by[self.find(i)].append(d)
        return [min(by[self.find(i)], key=lambda d: (d is None, d)) for i in range(len(ids))]


def exact(docs):
    by = defaultdict(list)
    for d, t in docs:
        by[(t or "").translate(LOWER)].append(d)
    out = []
    for t, ids in by.items():
        keep = max(ids, key=lambda d: (d is not None, d))
        out += [(d, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    return out


def jaccard(docs, n=5, percent=75):
    sets = []
    for _, t in docs:
        w = words((t or "").translate(LOWER))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    groups = Groups(len(docs))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                groups.link(i, j)
    return list(zip([d for d, _ in docs], map(len, sets), groups.least([d for d, _ in docs])))


def repeats(docs, width=13):
    rank = lambda d: (d is None, d or 0)  # noqa: E731  a null id orders last
    least = {}
    for d, t in docs:
        w = words(t)
        for k in range(len(w) - width + 1):
            x = tuple(w[k:k + width])
            least[x] = min(least.get(x, rank(d)), rank(d))
    out = []
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if least[tuple(w[k:k + width])] < rank(d):
                gone[k:k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), kept))
    return out


def vectors(rows, threshold):
    """rows: (id, vector, label) -> (id, links, least id of the component)."""
    def usable(v, label):
        return label is not None and v and all(e is not None and math.isfinite(e) for e in v) and any(v)

    groups, links = Groups(len(rows)), [0] * len(rows)
    for i, (_, x, lx) in enumerate(rows):
        for j in range(i):
            _, y, ly = rows[j]
            if lx == ly and usable(x, lx) and usable(y, ly) and len(x) == len(y):
                cos = sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))
                if cos >= threshold:
                    links[i] += 1
                    links[j] += 1
                    groups.link(i, j)
    ids = [r[0] for r in rows]
    return list(zip(ids, links, groups.least(ids)))


class Katz:
    def __init__(self, docs, folds=5):
        self.docs = [(d, words((t or "").translate(LOWER)) + [None], fold(d, folds)) for d, t in docs]
        self.uni, self.bi = Counter(), Counter()
        for _, w, held in self.docs:
            if not held:
                self.uni.update(w)
                self.bi.update(zip([0] + w[:-1], w))
        self.n, self.types = sum(self.uni.values()), len(self.uni)
        self.star1, self.star2 = self._stars(self.uni), self._stars(self.bi)
        self.unknown = 1 - sum(map(self.star1, self.uni.values())) / self.n
        self.after, self.history = defaultdict(list), Counter()
        for (h, w), c in self.bi.items():
            self.after[h].append((w, c))
            self.history[h] += c
        self.alpha = {h: (1 - sum(self.star2(c) for _, c in l) / self.history[h]) / (1 - sum(self.p1(w) for w, _ in l))
                      for h, l in self.after.items()}

    @staticmethod
    def _stars(counts):
        n = Counter(counts.values())

        def star(r):
            turing = (r + 1) * n[r + 1] / n[r] if r <= 5 else 0
            return turing if 0 < turing < r else r * r / (r + 1)
        return star

    def p1(self, w):
        return self.star1(self.uni[w]) / self.n if w in self.uni else self.unknown

    def p(self, h, w):
        if (h, w) in self.bi:
            return self.star2(self.bi[h, w]) / self.history[h]
        return self.alpha.get(h, 1.0) * self.p1(w)

    def scores(self):
        for d, w, held in self.docs:
            base = sum(math.log10((self.uni[x] + 0.5) / (self.n + 0.5 * (self.types + 1))) for x in w)
            yield (d, held, len(w), sum(x in self.uni for x in w), self.n, base,
                   sum(math.log10(self.p(a, b)) for a, b in zip([0] + w[:-1], w)))


def best_fit_decreasing(sizes, capacity):
    """Number of sequences that sequential best fit opens."""
    import bisect

    gaps, opened = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, s)
        room = gaps.pop(i) if i < len(gaps) else capacity
        opened += room == capacity
        bisect.insort(gaps, room - s) if room > s else None
    return opened


def targets(sizes, weights=(5, 2, 1), total=1.5, most=2.0):
    """{source: target} by sharing the excess again until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = total * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] >= most * sizes[s]}
        if not over:
            return out | {s: share * weight[s] for s in open_}
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return out
