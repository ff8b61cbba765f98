"""Removal of repeated passages by super-k-mer partitioning (operator 8).

A window is ``width`` consecutive words.  A window's minimiser is the run of
``seed_words`` of its words with the least hash.  Consecutive windows with one
minimiser form a super-k-mer: their words travel once, as one packed
string, to the bucket of the minimiser.  Equal windows have equal minimisers, so
they meet in one bucket, where the strings are cut into windows again and sorted:
each run of equal windows shows the least document id that has it, exactly.
Windows of documents with larger ids are marked, and marks go home as word ranges.

Strings travel in compressed packs, one per task, flush and bucket.  A pack holds
equal strings of its documents once, with the list of places where they stand; a
passage that very many documents share so costs a few bytes per occurrence.

Windows equal by a 64-bit hash are taken as equal only if a second, independent
64-bit hash agrees as well.

Defined cases: a null text has no words; texts shorter than a window stay whole;
a null id orders after all others; rows of one id do not remove from each other;
no rows give no rows.  Marks are judged on the input, not on what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .storage import release, save
from .text import whole
from .words import batches_of, grams, split_words, text_bytes

_U = np.uint64
_LAST = np.iinfo(np.int64).max  # stands for a null id
_PACK_SQL = "bucket int, n int, strings binary, places binary"
_PLACE = np.dtype([("string", "<i4"), ("word", "<i4"), ("doc", "<i8"), ("row", "<i8")])
_SPAN_SQL = "row long, doc_id long, first int, last int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def super_kmers(words, width: int, seed_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word + 1, minimiser) of the super-k-mers of a batch of documents."""
    seeds = grams(words.hash, seed_words, seed=3)
    if len(words.hash) < width:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, _U)
    low = sliding_min(seeds, width - seed_words + 1)[:len(words.hash) - width + 1]
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    inside = doc[:len(low)] == doc[width - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, _U)
    value = low[at]
    new = np.append(True, (np.diff(at) != 1) | (value[1:] != value[:-1]) | (doc[at[1:]] != doc[at[:-1]]))
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(at)) - 1
    return at[begin], at[stop] + width, value[begin]


def _spaced(words) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each word there): all words, each followed by one space."""
    sizes = words.end - words.start
    start = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(start[-1], 32, np.uint8)
    shift = np.repeat(words.start - start[:-1], sizes + 1)
    index = np.arange(start[-1])
    body = np.ones(start[-1], bool)
    body[start[1:] - 1] = False
    out[body] = words.data[(index + shift)[body]]
    return out, start


def _packs(width: int, seed_words: int, buckets: int, flush: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches_of(batches, 2, flush):
            words = split_words(*text_bytes(b.column(2)))
            a, z, minimiser = super_kmers(words, width, seed_words)
            if not len(a):
                continue
            text, start = _spaced(words)
            doc = np.searchsorted(words.first, a, "right") - 1
            doc_id = np.array([_LAST if x is None else x for x in b.column(0).to_pylist()], np.int64)
            row_id = b.column(1).to_numpy()
            bucket = (minimiser >> _U(20)) % _U(buckets)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 2 ** 16 else bucket, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1)), len(order))
            raw, rows = text.tobytes(), []
            s, e = start[a], start[z] - 1
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                own = order[i:j]
                known: dict[bytes, int] = {}
                number = [known.setdefault(raw[p:q], len(known)) for p, q in zip(s[own].tolist(), e[own].tolist())]
                places = np.empty(len(own), _PLACE)
                places["string"] = number
                places["word"] = a[own] - words.first[doc[own]]
                places["doc"], places["row"] = doc_id[doc[own]], row_id[doc[own]]
                rows.append((int(bucket[own[0]]), len(known), zip_.compress(b"\n".join(known)),
                             zip_.compress(b"".join(places[f].tobytes() for f in _PLACE.names))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                ["bucket", "n", "strings", "places"])

    return run


def _window_hashes(data: np.ndarray, width: int, limit: int = 1 << 20) -> Iterator[tuple]:
    """(windows of each string, two hashes of every window), some strings of a pack at a time."""
    lines = np.concatenate([[0], np.flatnonzero(data == 10) + 1, [len(data)]])
    at = 0
    while at < len(lines) - 1:
        stop = max(at + 1, int(np.searchsorted(lines, lines[at] + limit, "right")) - 1)
        words = split_words(data[lines[at]:lines[stop]], lines[at:stop + 1] - lines[at])
        counts = np.diff(words.first) - width + 1
        base = np.concatenate([[0], np.cumsum(counts)])
        index = np.arange(base[-1]) + np.repeat(words.first[:-1] - base[:-1], counts)
        yield counts, grams(words.hash, width)[index], grams(words.hash, width, seed=7)[index]
        at = stop


def _repeats(width: int):
    """One bucket: the word ranges whose windows a smaller document has as well."""
    def run(table: pa.Table) -> pa.Table:
        unzip = zstandard.ZstdDecompressor()
        places, counts, one, two, n = [], [], [], [], 0
        for k, s, p in zip(table.column("n").to_pylist(), table.column("strings"), table.column("places")):
            for part in _window_hashes(np.frombuffer(unzip.decompress(s.as_buffer()), np.uint8), width):
                for held, x in zip((counts, one, two), part):
                    held.append(x)
            raw = unzip.decompress(p.as_buffer())
            rows = len(raw) // _PLACE.itemsize
            part, at = np.empty(rows, _PLACE), 0
            for f in _PLACE.names:
                size = rows * _PLACE[f].itemsize
                part[f] = np.frombuffer(raw, _PLACE[f], rows, at)
                at += size
            part["string"] += n
            n += k
            places.append(part)
        places, counts, one, two = (np.concatenate(x) for x in (places, counts, one, two))
        base = np.concatenate([[0], np.cumsum(counts)])
        # the least document of each string, then of each distinct window
        low = np.full(n, _LAST, np.int64)
        np.minimum.at(low, places["string"], places["doc"])
        owner = np.repeat(low, counts)
        order = np.argsort(one, kind="stable")
        same = one[order][1:] == one[order][:-1]
        if (same & (two[order][1:] != two[order][:-1])).any():  # two windows share the first hash
            order = np.lexsort((two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        first = np.flatnonzero(np.append(True, ~same))
        least = np.empty(base[-1], np.int64)
        least[order] = np.repeat(np.minimum.reduceat(owner[order], first), np.diff(np.append(first, base[-1])))
        # strings with a window that a place of theirs has to give up
        most = np.full(n, -1 << 63, np.int64)
        np.maximum.at(most, places["string"], places["doc"])
        some = np.bitwise_or.reduceat(least < np.repeat(most, counts), base[:-1])
        places = places[some[places["string"]]]
        size = counts[places["string"]]
        where = np.concatenate([[0], np.cumsum(size)])
        window = np.arange(where[-1]) + np.repeat(base[places["string"]] - where[:-1], size)
        place = np.repeat(np.arange(len(places)), size)
        marked = least[window] < places["doc"][place]
        offset = (np.arange(where[-1]) - np.repeat(where[:-1], size))[marked]
        place = place[marked]
        new = np.append(True, (np.diff(place) != 0) | (np.diff(offset) != 1)) if len(place) else np.empty(0, bool)
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(place)) - 1 if len(begin) else begin
        p = places[place[begin]]
        doc = pa.array(p["doc"], mask=p["doc"] == _LAST)
        return pa.table({"row": pa.array(p["row"]), "doc_id": doc,
                         "first": pa.array((p["word"] + offset[begin]).astype(np.int32)),
                         "last": pa.array((p["word"] + offset[stop] + width).astype(np.int32))})

    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and their marked ranges to the words that stay."""
    for b in batches_of(batches, 1):
        words = split_words(*text_bytes(b.column(1)))
        text, start = _spaced(words)
        raw, out = text.tobytes(), []
        for i, spans in enumerate(b.column(2).to_pylist()):
            a, z = int(words.first[i]), int(words.first[i + 1])
            parts, at, gone = [], 0, 0
            for s in sorted((s["first"], s["last"]) for s in spans or ()):
                if s[1] <= at:
                    continue
                if s[0] > at:
                    parts.append(raw[start[a + at]:start[a + s[0]]])
                gone += s[1] - max(at, s[0])
                at = s[1]
            parts.append(raw[start[a + at]:start[z]])
            out.append((z - a, gone, b"".join(parts)[:-1].decode("utf-8", "replace")))
        cols = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text"])


def repeated_spans(docs: DataFrame, *, width: int = 13, seed_words: int = 3, id_col: str = "doc_id",
                   text_col: str = "text", bucket_bytes: int = 16 << 20) -> DataFrame:
    """Word ranges (row, doc_id, first, last + 1) to remove; ``row`` is a hash of id and text."""
    texts = _texts(docs, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total // bucket_bytes
    packs = texts.mapInArrow(_packs(width, seed_words, buckets), _PACK_SQL)
    return packs.groupBy("bucket").applyInArrow(_repeats(width), _SPAN_SQL)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(F.col(text_col))
    doc = F.col(id_col).cast("long")
    return docs.select(doc.alias("doc_id"), F.xxhash64(doc, text).alias("row"), text.alias("text"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text."""
    spans = save(repeated_spans(docs, id_col=id_col, text_col=text_col, **kwargs), "spans")
    release(docs.sparkSession)  # the packs' shuffle files, before the texts are shuffled
    marks = spans.groupBy("row", "doc_id").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    marks = marks.select("row", F.col("doc_id").alias("of"), "spans")
    texts = _texts(docs, id_col, text_col)
    met = texts.join(marks, (texts.row == marks.row) & texts.doc_id.eqNullSafe(marks.of), "left")
    return met.select("doc_id", "text", "spans").mapInArrow(
        _keep, "doc_id long, n_words long, n_removed long, kept_text string")
