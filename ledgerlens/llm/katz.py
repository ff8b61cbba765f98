"""Katz backoff language model of words (operator 6).

Tokens are a document's words, then one end; each has the token before it (or the
begin mark) as history.  With c the training counts:

    P(w | h) = r*(c(h, w)) / c(h)   if c(h, w) > 0
             = a(h) * P(w)          if not           (a = 1 for an unknown history)
    P(w)     = r*(c(w)) / N         if c(w) > 0
             = what these leave     for the one event "unknown word"

r* is the Good-Turing estimate, at each order from its own counts of counts n_r:
(r + 1) n_{r+1} / n_r for r up to ``TURING`` where that is between 0 and r, else that
of Zipf's law n_r ~ r^-2, r* = r^2 / (r + 1).  Every count is discounted, so every
history leaves mass, and a(h) = (1 - sum of seen P(w|h)) / (1 - sum of their P(w))
normalises it exactly.

How it runs: tokens are hashed to 64 bits; only packed arrays travel, in three
exchanges.

1. Tasks group their tokens by (word, history) and send each group, with its
   training count and the documents it stands in, to a bucket of the word.  A
   bucket counts exactly, writes its part of the n-gram table and of the counts
   of counts, and adds up per document what depends on the constants only through
   the class of a count.  Groups unseen in training go on to a bucket of the history.
2. With the constants known, each part of the n-gram table gives the seen mass per
   history; the buckets of histories form the backoff weights and add up what
   the unseen groups owe.
3. Per task of the first step, all sums of its documents meet.

Nothing is capped: every document is counted or scored token by token.

Defined cases: a null or empty text is its end token alone; a null id counts as an
empty string for the fold; without training rows every token is unknown with
probability 1, and the base score is that of N = V = 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .storage import new_path, release
from .text import whole
from .words import batches_of, mix64, split_words, text_bytes

_U = np.uint64
BEGIN, END = _U(0x1B873593CC9E2D51), _U(0xE6546B64AF251E9D)
TURING = 5
#: Classes of a token: seen bigram of count 1..TURING, above; unseen with a word of count 0, 1..TURING, above.
_SEEN, _UNSEEN, _CLASSES = 0, TURING + 1, 2 * TURING + 3
_ROW_SQL = "kind int, key long, part long, n double, payload binary"
_ROW = [("kind", pa.int32()), ("key", pa.int64()), ("part", pa.int64()), ("n", pa.float64()), ("payload", pa.binary())]
_DOCS, _PAIRS, _SUMS, _OWED, _STATS, _MASS = range(6)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed payload; integers in the narrowest type that holds them."""
    out, head = [], []
    for a in arrays:
        if a.dtype.kind in "iu" and a.dtype.itemsize > 1 and len(a) and a.min() >= 0:
            a = a.astype(np.min_scalar_type(int(a.max())))
        head.append(f"{a.dtype.str}{len(a)}")
        out.append(a.tobytes())
    return zstandard.ZstdCompressor(level=1).compress((",".join(head) + "\n").encode() + b"".join(out))


def unpack(payload: pa.Scalar | bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload.as_buffer() if isinstance(payload, pa.Scalar) else payload)
    end = raw.index(b"\n")
    at, out = end + 1, []
    for field in raw[:end].decode().split(","):
        kind, n = np.dtype(field[:3]), int(field[3:])
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * kind.itemsize
    return out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(_ROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _ROW)], [n for n, _ in _ROW])


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high half of a mixed hash; grows with it, so sorted hashes have sorted buckets."""
    return ((x >> _U(32)) * _U(buckets)) >> _U(32)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted arrays."""
    new = np.zeros(len(keys[0]), bool)
    if len(new):
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _chunks(buckets: int, flush: int = 2_000_000, most_docs: int = 60_000):
    """Documents (doc_id, text, held) to grouped tokens by bucket of the word, and the documents' own rows."""
    def chunk(uid: int, held: list, words: list, histories: list, sizes: list) -> Iterator[tuple]:
        w, h, n = np.concatenate(words), np.concatenate(histories), np.concatenate(sizes)
        out = np.array([x for _, x in held], bool)
        ids = [x for x, _ in held]
        null = np.array([x is None for x in ids], np.uint8)
        yield (_DOCS, uid, uid % buckets, 0.0,
               pack(np.array([x or 0 for x in ids], np.int64), null, out.astype(np.uint8), n))
        assert len(n) <= 1 << 16, "documents of a chunk are numbered in 16 bits"
        doc = np.repeat(np.arange(len(n), dtype=np.uint16), n)
        mixed = mix64(w)
        order = np.argsort((mixed & _U(0xFFFFFFFF00000000)) | (mix64(w * _U(0x9E3779B97F4A7C15) + h) >> _U(32)))
        w, h, doc, mixed = w[order], h[order], doc[order], mixed[order]
        pair = _runs(w, h)
        count = _sizes(pair, len(w))
        train = np.add.reduceat((~out[doc]).astype(np.int64), pair)
        pw, ph, bucket = w[pair], h[pair], _bucket(mixed[pair], buckets)
        cuts = np.append(_runs(bucket), len(bucket))
        where = np.append(pair, len(w))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            word = _runs(pw[a:z])
            yield (_PAIRS, uid, int(bucket[a]), float(len(n)),
                   pack(pw[a:z][word], _sizes(word, z - a), ph[a:z], train[a:z], count[a:z], doc[where[a]:where[z]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 24
        held, words, histories, sizes, have = [], [], [], [], 0
        for b in batches_of(batches, 1):
            x = split_words(*text_bytes(b.column(1)), lower=True)
            if len(held) + b.num_rows > most_docs and held:
                yield _rows(list(chunk(uid, held, words, histories, sizes)))
                held, words, histories, sizes, have, uid = [], [], [], [], 0, uid + 1
            words.append(np.insert(x.hash, x.first[1:], END))
            histories.append(np.insert(x.hash, x.first[:-1], BEGIN))
            sizes.append(np.diff(x.first) + 1)
            held += zip(b.column(0).to_pylist(), b.column(2).to_pylist())
            have += len(words[-1])
            if have > flush:
                yield _rows(list(chunk(uid, held, words, histories, sizes)))
                held, words, histories, sizes, have, uid = [], [], [], [], 0, uid + 1
        if held:
            yield _rows(list(chunk(uid, held, words, histories, sizes)))

    return run


def _log(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def _count(buckets: int):
    """One bucket of words: its n-gram table, counts of counts, sums per document, and unseen groups."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        out = [tuple(r.values()) for r in table.filter(pa.array(kind == _DOCS)).to_pylist()]
        own = table.filter(pa.array(kind == _PAIRS))
        uids, n_docs = own.column("key").to_pylist(), own.column("n").to_numpy().astype(np.int64)
        base = np.concatenate([[0], np.cumsum(n_docs)])
        parts = [unpack(p) for p in own.column("payload")]
        if not parts:
            return pa.Table.from_batches([_rows(out)])
        w = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        h, train, count = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
        doc = np.concatenate([p[5].astype(np.int32) + np.int32(b) for p, b in zip(parts, base)])
        del parts  # a bucket is the largest thing a task holds: nothing stays longer than it is needed
        order = np.lexsort((h, w)).astype(np.int32)
        ws, hs = w[order], h[order]
        pair = _runs(ws, hs)
        total = np.add.reduceat(train[order].astype(np.int64), pair)   # c(h, w)
        ws, hs = ws[pair], hs[pair]
        word = _runs(ws)
        all_of = np.add.reduceat(total, word)                          # c(w)
        word_of = np.repeat(np.arange(len(word), dtype=np.int32), _sizes(word, len(pair)))
        pair_of = np.empty(len(w), np.int32)
        pair_of[order] = np.repeat(np.arange(len(pair), dtype=np.int32), _sizes(pair, len(w)))
        ends = w == END
        del order, train, w
        # the table: words of this bucket with the histories seen before them
        seen = total > 0
        known = all_of > 0
        key = int(own.column("part")[0].as_py())
        out.append((_PAIRS, key, 0, 0.0, pack(ws[word][known], all_of[known],
                                              np.add.reduceat(seen.astype(np.int64), word)[known], hs[seen], total[seen])))
        for order_, c in ((2, total[seen]), (1, all_of[known])):
            n_r = np.bincount(np.minimum(c, TURING + 2), minlength=TURING + 3)
            out += [(_STATS, order_, r, float(n_r[r]), None) for r in range(1, TURING + 2)]
        c = all_of[known].astype(np.float64)
        high = c > TURING
        out += [(_STATS, 1, -1, float(c.sum()), None), (_STATS, 1, -2, float(len(c)), None),
                (_STATS, 1, -3, float((c[high] ** 2 / (c[high] + 1)).sum()), None),
                (_STATS, 1, -4, float(all_of[ws[word] == END].sum()), None)]
        del ws, hs, seen, known
        # per group, then per document
        c2, c1 = total[pair_of], all_of[word_of[pair_of]]
        del pair_of, word_of, total
        n, docs = count.astype(np.int64), int(base[-1])
        group_class = np.where(c2 > 0, _SEEN + np.minimum(c2, TURING + 1) - 1, _UNSEEN + np.minimum(c1, TURING + 1))
        at = doc.astype(np.int64) * _CLASSES
        at += np.repeat(group_class.astype(np.int8), n)
        classes = np.bincount(at, minlength=docs * _CLASSES).astype(np.int32).reshape(docs, _CLASSES)
        del at, group_class
        used = np.where(c2 > 0, c2, c1).astype(np.float64)
        sums = [np.bincount(doc, np.repeat(x, n), docs) for x in (
            np.where(used > TURING, _log(used * used / (used + 1)), 0.0), _log(c1 + 0.5),
            np.where((c1 > 0) & ~ends, _log(c1.astype(np.float64)), 0.0))]
        del used, ends, c1
        for uid, a, z in zip(uids, base[:-1].tolist(), base[1:].tolist()):
            out.append((_SUMS, uid, 0, 0.0, pack(classes[a:z].reshape(-1), sums[0][a:z].astype(np.float32),
                                                 sums[1][a:z], sums[2][a:z].astype(np.float32))))
        # unseen groups go to their history
        owed = np.repeat(c2 == 0, n)
        if owed.any():
            oh, od = np.repeat(h, n)[owed], doc[owed]
            to = _bucket(mix64(oh), buckets)
            order = np.lexsort((od, to.astype(np.int32)))
            oh, od, to = oh[order], od[order], to[order]
            cuts = np.append(_runs(to), len(to))
            chunk = (np.searchsorted(base, od, "right") - 1).astype(np.int64)
            uid_list = np.array(uids, np.int64)
            for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                out.append((_OWED, int(to[a]), 0, 0.0, pack(uid_list, chunk[a:z], (od[a:z] - base[chunk[a:z]]), oh[a:z])))
        return pa.Table.from_batches([_rows(out)])

    return run


class Discounts:
    """The Good-Turing estimates of both orders and the totals of the training tokens."""

    def __init__(self, stats: dict[tuple[int, int], float]) -> None:
        self.tokens = int(stats.get((1, -1), 0))
        self.types = int(stats.get((1, -2), 0))
        self.ends = int(stats.get((1, -4), 0))
        self.star = {}
        for order in (1, 2):
            n = [stats.get((order, r), 0.0) for r in range(TURING + 2)]
            star = [0.0]
            for r in range(1, TURING + 1):
                turing = (r + 1) * n[r + 1] / n[r] if n[r] else 0.0
                star.append(turing if 0 < turing < r else r * r / (r + 1))
            self.star[order] = np.array(star)
        low = sum(stats.get((1, r), 0.0) * self.star[1][r] for r in range(1, TURING + 1))
        self.unknown = 1 - (low + stats.get((1, -3), 0.0)) / self.tokens if self.tokens else 1.0

    def estimate(self, order: int, c: np.ndarray) -> np.ndarray:
        c = c.astype(np.float64)
        return np.where(c > TURING, c * c / (c + 1), self.star[order][np.minimum(c, TURING).astype(np.int64)])

    def class_logs(self) -> np.ndarray:
        """log10 that a class of token gives besides its sums: r* where it is not in them, and 1 / N of unigrams."""
        out = np.zeros(_CLASSES)
        per = -math.log10(self.tokens) if self.tokens else 0.0
        for r in range(1, TURING + 1):
            out[_SEEN + r - 1] = math.log10(self.star[2][r])
            out[_UNSEEN + r] = math.log10(self.star[1][r]) + per
        out[_UNSEEN] = math.log10(self.unknown)
        out[_UNSEEN + TURING + 1] = per
        return out


def _mass(d: Discounts, buckets: int):
    """A part of the n-gram table to the seen mass per history, by bucket of the history."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload in b.column(0):
                w, c1, n, h, c2 = unpack(payload)
                low = np.repeat(d.estimate(1, c1) / max(1, d.tokens), n)
                mixed = mix64(h)
                order = np.argsort(mixed)  # mixing is one-to-one, so equal histories lie together
                h, mixed, c2 = h[order], mixed[order], c2[order]
                run_ = _runs(h)
                if not len(run_):
                    continue
                sums = [np.add.reduceat(x, run_) for x in (d.estimate(2, c2), low[order], c2.astype(np.int64))]
                to = _bucket(mixed[run_], buckets)
                cuts = np.append(_runs(to), len(to))
                yield _rows([(_MASS, int(to[a]), 0, 0.0, pack(h[run_][a:z], sums[0][a:z], sums[1][a:z], sums[2][a:z]))
                             for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())])

    return run


def _backoff(table: pa.Table) -> pa.Table:
    """One bucket of histories: what the unseen groups of each document owe to the weights."""
    kind = table.column("kind").to_numpy()
    owed = [unpack(p) for p in table.column("payload").filter(pa.array(kind == _OWED))]
    if not owed:
        return pa.Table.from_batches([_rows([])])
    uids, uid_of = np.unique(np.concatenate([o[0] for o in owed]), return_inverse=True)
    first = np.concatenate([[0], np.cumsum([len(o[0]) for o in owed])])
    chunk = np.concatenate([uid_of.reshape(-1)[o[1].astype(np.int64) + f] for o, f in zip(owed, first)])
    doc, need = (np.concatenate([o[i] for o in owed]) for i in (2, 3))
    doc = doc.astype(np.int64)
    value = np.zeros(len(need))
    mass = [unpack(p) for p in table.column("payload").filter(pa.array(kind == _MASS))]
    if mass:
        h = np.concatenate([m[0] for m in mass])
        order = np.argsort(h)
        h = h[order]
        run_ = _runs(h)
        seen, low, c = (np.add.reduceat(np.concatenate([m[i] for m in mass])[order].astype(np.float64), run_) for i in (1, 2, 3))
        known = h[run_]
        # the sums took -log10 c(h) of every known history; an unseen group owes log10 a(h) in its place
        weight = _log((1 - seen / c) / (1 - low)) + _log(c)
        at = np.minimum(np.searchsorted(known, need), len(known) - 1)
        value = np.where(known[at] == need, weight[at], 0.0)
    order = np.lexsort((doc, chunk))
    chunk, doc, value = chunk[order], doc[order], value[order]
    run_ = _runs(chunk, doc)
    total = np.add.reduceat(value, run_)
    chunk, doc = chunk[run_], doc[run_]
    cuts = np.append(_runs(chunk), len(chunk))
    return pa.Table.from_batches([_rows([
        (_OWED, int(uids[chunk[a]]), 0, 0.0, pack(doc[a:z], total[a:z]))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())])])


_SCORE = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
          ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
_SCORE_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(d: Discounts):
    """All sums of one task's documents to their scores."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        payloads = table.column("payload")
        ids, null, out, n = unpack(payloads.filter(pa.array(kind == _DOCS))[0])
        classes = np.zeros((len(ids), _CLASSES))
        zipf, base, history, owed = (np.zeros(len(ids)) for _ in range(4))
        for p in payloads.filter(pa.array(kind == _SUMS)):
            a, b, c, e = unpack(p)
            classes += a.reshape(-1, _CLASSES)
            zipf += b
            base += c
            history += e
        for p in payloads.filter(pa.array(kind == _OWED)):
            at, value = unpack(p)
            owed[at.astype(np.int64)] += value
        if d.ends:
            history += math.log10(d.ends)  # the begin mark
        n = n.astype(np.int64)
        score = classes @ d.class_logs() + zipf - history + owed
        base -= n * math.log10(d.tokens + 0.5 * (d.types + 1))
        cols = [pa.array(ids.astype(np.int64), mask=null == 1), pa.array(out == 1), pa.array(n),
                pa.array(n - classes[:, _UNSEEN].astype(np.int64)), pa.array(np.full(len(n), d.tokens, np.int64)),
                pa.array(base), pa.array(score)]
        return pa.Table.from_arrays(cols, [x for x, _ in _SCORE])

    return run


def katz_scores(docs: DataFrame, *, folds: int = 5, id_col: str = "doc_id", text_col: str = "text",
                bucket_bytes: int = 20 << 20, path: str | None = None) -> DataFrame:
    """Train on all folds but 1 and score every document.

    The tables (partitioned by kind: the n-grams with their counts, the counts of
    counts, the sums) are written to ``path``, else into the shared folder.
    """
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 1
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"), held.alias("held"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total // bucket_bytes
    path = path or new_path(spark, "katz")
    (texts.mapInArrow(_chunks(buckets), _ROW_SQL).groupBy("part").applyInArrow(_count(buckets), _ROW_SQL)
     .write.option("compression", "none").partitionBy("kind").parquet(path))  # payloads are compressed already
    release(spark)
    table = spark.read.schema("key long, part long, n double, payload binary, kind int").parquet(path)
    stats = table.where(F.col("kind") == _STATS).groupBy("key", "part").agg(F.sum("n").alias("n")).collect()
    d = Discounts({(r.key, r.part): r.n for r in stats})
    columns = ["kind", "key", "part", "n", "payload"]
    mass = table.where(F.col("kind") == _PAIRS).select("payload").mapInArrow(_mass(d, buckets), _ROW_SQL)
    owed = (table.where(F.col("kind") == _OWED).select(*columns).unionByName(mass)
            .groupBy("key").applyInArrow(_backoff, _ROW_SQL))
    sums = table.where(F.col("kind").isin(_DOCS, _SUMS)).select(*columns)
    return sums.unionByName(owed).groupBy("key").applyInArrow(_score(d), _SCORE_SQL)
