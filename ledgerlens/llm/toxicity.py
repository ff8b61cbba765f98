"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 5).

Inputs of a word are its own vector, where training knows the word, and the means of
the vectors of its character trigrams and of its openings.  A gated recurrent layer reads a window of
words forwards, another backwards; attention weighs the states; their mean gives the
window's logit.  A text's score is that of its worst window, over overlapping
windows that cover the whole text.

Training is plain numpy, on at most ``sample_docs`` labelled documents (a third of them
toxic at most; chosen by hash) - its documented bound.  As labels are given per document,
each three passes take every document's worst window under the present model (at first,
the one whose words have the highest smoothed log-odds) and follow its gradient.  Tasks
find these windows over the whole texts, a megabyte at a time, and send one window a
document, in which a word counts each trigram row once; one task learns from them.  What
the optimiser remembers goes from that task to the next one through a table in the shared
folder.  The driver holds the sample's ids and hands the present model (the network and
the words of at least three sampled documents) on to the tasks as it came, in bytes.
Scoring broadcasts the trained arrays and runs in tasks, on whole texts, a megabyte of
text at a time.

A document labelled more than once counts as toxic if any of its labels says so.

Defined cases: a null or empty text is one window without words; a null id counts
as an empty string for the fold; without any labelled row every score is 0.5.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .katz import pack, unpack
from .storage import release, remove_table, save
from .text import whole
from .tokens import drop_encoders
from .words import Words, batches_of, give_back, split_words, text_bytes

_U = np.uint64
WINDOW, STRIDE = 64, 32
WORD_DIM, CHAR_DIM, HIDDEN, CHAR_ROWS = 8, 8, 8, 4096
#: Openings of a word, in bytes: insults are often inflected at the end.
OPENINGS, OPENING_ROWS = (5, 6, 7, 8, 10), 1 << 14
#: ASCII punctuation parts words too, so that "idiot!" is the word "idiot".
_BETWEEN = np.array([c <= 32 or (c < 128 and not chr(c).isalnum()) for c in range(256)])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Batch(NamedTuple):
    """Distinct words of some texts and the windows over them."""

    hashes: np.ndarray   # of the distinct words
    grams: np.ndarray    # trigram rows of all distinct words
    share: np.ndarray    # of each of them in its word
    cuts: np.ndarray     # first trigram of each distinct word
    opens: np.ndarray    # distinct words x OPENINGS: row of each opening, 0 where the word is shorter
    index: np.ndarray    # windows x WINDOW: distinct word, or their number for no word
    doc: np.ndarray      # of each window


def _words(column: pa.Array, limit: int = 1 << 20) -> Words:
    """Words in lower case, found some texts at a time: a word costs more bytes while it is looked for than after."""
    data, offsets = text_bytes(column)
    parts, at, words = [], 0, 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        a = int(offsets[at])
        w = split_words(_FOLD[data[a:offsets[stop]]], offsets[at:stop + 1] - a, between=_BETWEEN)
        parts.append((w.start + a, w.end + a, w.first[:-1] + words, w.hash))
        words += len(w.hash)
        at = stop
    if len(parts) == 1:
        (start, end, first, hashes), = parts
    else:
        start, end, first, hashes = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 3 + [np.empty(0, _U)]
    return Words(data, start, end, np.append(first, words), hashes)


def batch_of(column: pa.Array) -> Batch:
    w = _words(column)
    hashes, at, word = np.unique(w.hash, return_index=True, return_inverse=True)
    # trigrams: each byte of a word with its neighbours, 0 beyond the word
    size = w.end[at] - w.start[at]
    cuts = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(cuts[-1]) - np.repeat(cuts[:-1], size)
    byte = np.repeat(w.start[at], size) + place
    own = _FOLD[w.data[byte]].astype(np.uint32)
    left, right = np.zeros_like(own), np.zeros_like(own)
    left[1:], right[:-1] = own[:-1], own[1:]
    left[place == 0] = 0
    right[place == np.repeat(size, size) - 1] = 0
    code = (left * np.uint32(65537) + own * np.uint32(257) + right) * np.uint32(2654435761)
    grams = (code >> np.uint32(20)).astype(np.int32) % CHAR_ROWS
    opens = np.zeros((len(at), len(OPENINGS)), np.int32)
    hashed, done = np.zeros(len(at), np.uint32), 0
    for i, length in enumerate(OPENINGS):
        for k in range(done, length):
            byte_k = own[np.minimum(cuts[:-1] + k, len(own) - 1)] if len(own) else hashed
            hashed = (hashed + byte_k + np.uint32(1)) * np.uint32(2654435761)
        done = length
        opens[:, i] = np.where(size >= length, 1 + (hashed >> np.uint32(16)) % (OPENING_ROWS - 1), 0)
    # windows: every STRIDE words, the last one ending with the text
    n = np.diff(w.first)
    count = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.minimum(k * STRIDE, np.maximum(n[doc] - WINDOW, 0))
    place = begin[:, None] + np.arange(WINDOW)
    inside = place < n[doc][:, None]
    row = np.append(word.reshape(-1), 0)[np.where(inside, w.first[:-1][doc][:, None] + place, len(word))]
    share = np.repeat(1 / size.astype(np.float32), size)
    return Batch(hashes, grams, share, cuts, opens, np.where(inside, row, len(hashes)).astype(np.int32), doc)


def _words_of(b: Batch, words: np.ndarray) -> tuple[np.ndarray, ...]:
    """The first fields of a batch for some of its distinct words."""
    size = np.diff(b.cuts)[words]
    cuts = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(b.cuts[words] - cuts[:-1], size) + np.arange(cuts[-1])
    return b.hashes[words], b.grams[at], b.share[at], cuts, b.opens[words]


def windows_of(b: Batch, at: np.ndarray) -> Batch:
    """Some windows with their own words alone."""
    words, back = np.unique(b.index[at], return_inverse=True)
    return Batch(*_words_of(b, words[words < len(b.hashes)]),
                 back.reshape(-1, WINDOW).astype(np.int32), b.doc[at])


def merged(b: Batch) -> Batch:
    """Equal trigram rows of a word as one."""
    n = len(b.hashes)
    key, of = np.unique(np.repeat(np.arange(n), np.diff(b.cuts)) * CHAR_ROWS + b.grams, return_inverse=True)
    share = np.bincount(of.reshape(-1), weights=b.share, minlength=len(key)).astype(np.float32)
    return b._replace(grams=(key % CHAR_ROWS).astype(np.int32), share=share,
                      cuts=np.searchsorted(key, np.arange(n + 1) * CHAR_ROWS))


def joined(parts: list[Batch]) -> Batch:
    """The windows of several batches over their distinct words, in the order of the batches."""
    base = np.cumsum([0, *(len(b.hashes) for b in parts)])
    cut = np.cumsum([0, *(len(b.grams) for b in parts)])
    index = np.concatenate([np.where(b.index < len(b.hashes), b.index + a, base[-1]) for b, a in zip(parts, base)])
    every = Batch(*(np.concatenate([b[i] for b in parts]) for i in range(3)),
                  np.append(np.concatenate([b.cuts[:-1] + c for b, c in zip(parts, cut)]), cut[-1]),
                  np.concatenate([b.opens for b in parts]), index, np.arange(len(index)))
    hashes, first, of = np.unique(every.hashes, return_index=True, return_inverse=True)
    return Batch(*_words_of(every, first), np.append(of.reshape(-1), len(hashes))[index].astype(np.int32), every.doc)


def new_params(words: int, odds: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def draw(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    dim, h = WORD_DIM + 2 * CHAR_DIM, HIDDEN
    p = {"words": draw(words + 1, WORD_DIM, scale=0.1), "chars": draw(CHAR_ROWS, CHAR_DIM, scale=0.1),
         "opens": draw(OPENING_ROWS, CHAR_DIM, scale=0.1), "query": np.zeros(2 * h, np.float32), "out": draw(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}
    p["words"][0] = 0  # a word that training does not know
    p["opens"][0] = 0  # a word shorter than the opening
    p["words"][1:, 0] = odds
    for d in ("f", "b"):
        p[f"in_{d}"], p[f"in_bias_{d}"] = draw(dim, 3 * h, scale=0.3), np.zeros(3 * h, np.float32)
        p[f"re_{d}"] = draw(h, 3 * h, scale=0.3)
    return p


def _vectors(p: dict, vocabulary: np.ndarray, b: Batch, hide: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(inputs of the distinct words, their row among the known words, 0 if unknown)."""
    row = np.zeros(len(b.hashes), np.int64)
    if len(vocabulary) and len(b.hashes):
        at = np.minimum(np.searchsorted(vocabulary, b.hashes), len(vocabulary) - 1)
        row = np.where(vocabulary[at] == b.hashes, at + 1, 0)
        if hide is not None:
            row[hide] = 0
    chars = np.add.reduceat(p["chars"][b.grams] * b.share[:, None], b.cuts[:-1], axis=0) \
        if len(b.hashes) else np.empty((0, CHAR_DIM), np.float32)
    opens = p["opens"][b.opens].mean(axis=1) if len(b.hashes) else chars
    return np.hstack([p["words"][row], chars, opens]).astype(np.float32), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, 60, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _read(p: dict, d: str, table: np.ndarray, index: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
    """States (steps, windows, HIDDEN) of one direction; ``keep`` gets what the gradient needs."""
    h, u, out = np.zeros((len(index), HIDDEN), np.float32), p[f"re_{d}"], np.empty((WINDOW, len(index), HIDDEN), np.float32)
    for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
        x, g = table[index[:, t]], h @ u
        zr = _sigmoid(x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[:, t, None], new, h)
        if keep is not None:
            keep.append((t, h, z, r, n, g[:, 2 * HIDDEN:]))
        h = out[t] = new
    return out


def logits(p: dict, tables: dict, index: np.ndarray, pad: int, keep: dict | None = None) -> np.ndarray:
    """Logit of each window; ``tables``: projected inputs of the distinct words by direction."""
    mask = index < pad
    masked = not mask.all()
    states = np.concatenate([_read(p, d, tables[d], index, mask if masked else None,
                                   None if keep is None else keep.setdefault(d, [])) for d in "fb"], axis=2)
    weight = np.exp(np.clip(states @ p["query"], -30, 30))
    if masked:
        weight *= mask.T
    weight /= np.maximum(weight.sum(axis=0), 1e-30)
    pooled = np.einsum("tw,twh->wh", weight, states)
    if keep is not None:
        keep.update(mask=mask, states=states, weight=weight, pooled=pooled)
    return pooled @ p["out"] + p["bias"][0]


def project(p: dict, x: np.ndarray) -> dict[str, np.ndarray]:
    """Inputs of both directions for every distinct word and, last, for no word."""
    return {d: np.vstack([x @ p[f"in_{d}"] + p[f"in_bias_{d}"], np.zeros((1, 3 * HIDDEN), np.float32)]) for d in "fb"}


def gradients(p: dict, vocabulary: np.ndarray, b: Batch, index: np.ndarray, label: np.ndarray,
              weight: np.ndarray, hide: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted cross entropy of windows and its gradient."""
    x, row = _vectors(p, vocabulary, b, hide)
    keep: dict = {}
    logit = logits(p, project(p, x), index, len(b.hashes), keep)
    score = _sigmoid(logit.astype(np.float32).copy())
    loss = float(-(weight * np.log(np.where(label > 0, score, 1 - score) + 1e-7)).mean())
    dl = (weight * (score - label) / len(label)).astype(np.float32)
    g = {"out": dl @ keep["pooled"], "bias": np.array([dl.sum()], np.float32)}
    dpool, states, a = dl[:, None] * p["out"], keep["states"], keep["weight"]
    along = np.einsum("twh,wh->tw", states, dpool)
    ds = a * (along - (a * along).sum(axis=0))
    g["query"] = np.einsum("tw,twh->h", ds, states)
    dstates = a[:, :, None] * dpool + ds[:, :, None] * p["query"]
    dx = np.zeros_like(x)
    for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
        u, dh = p[f"re_{d}"], np.zeros((len(index), HIDDEN), np.float32)
        du, dtable = np.zeros_like(u), np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
        for t, h, z, r, n, gn in reversed(keep[d]):
            dh = dh + dstates[t][:, part]
            on = keep["mask"][:, t, None].astype(np.float32)
            step = dh * on
            dn = step * (1 - z) * (1 - n * n)
            dz = step * (h - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            gates = np.hstack([dz, dr, dn * r])
            du += h.T @ gates
            np.add.at(dtable, index[:, t], np.hstack([dz, dr, dn]))
            dh = dh * (1 - on) + step * z + gates @ u.T
        dtable = dtable[:-1]
        g[f"re_{d}"], g[f"in_{d}"], g[f"in_bias_{d}"] = du, x.T @ dtable, dtable.sum(axis=0)
        dx += dtable @ p[f"in_{d}"].T
    g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
    np.add.at(g["words"], row, dx[:, :WORD_DIM])
    g["words"][0] = 0
    size = np.diff(b.cuts)
    chars, opens = dx[:, WORD_DIM:WORD_DIM + CHAR_DIM], dx[:, WORD_DIM + CHAR_DIM:]
    np.add.at(g["chars"], b.grams, np.repeat(chars, size, axis=0) * b.share[:, None])
    g["opens"] = np.zeros_like(p["opens"])
    for i in range(len(OPENINGS)):
        np.add.at(g["opens"], b.opens[:, i], opens / len(OPENINGS))
    g["opens"][0] = 0
    return loss, g


def count_words(b: Batch, labels: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, toxic documents) that have each distinct word."""
    n_words = len(b.hashes)
    pair = (b.doc[:, None].astype(np.int64) * (n_words + 1) + b.index).reshape(-1)
    pair.sort()
    pair = pair[np.append(True, pair[1:] != pair[:-1])]
    doc, word = pair // (n_words + 1), pair % (n_words + 1)
    doc, word = doc[word < n_words], word[word < n_words]
    return (np.bincount(word, weights=times[doc], minlength=n_words),
            np.bincount(word, weights=(times * labels)[doc], minlength=n_words))


def first_state(words: np.ndarray, have: np.ndarray, bad: np.ndarray, n_bad: float, n_good: float, seed: int = 5) -> dict:
    """What training knows before its first step; ``words``: ascending, with the documents that have them."""
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((have - bad + 0.5) / (n_good + 1))
    odds *= have / (have + 4.0)
    p = new_params(len(words), np.clip(odds, -2, 4).astype(np.float32), seed)
    return {"step": 0, "vocabulary": words, "hint": np.maximum(odds, 0).astype(np.float32), "p": p,
            "mean": {k: np.zeros_like(v) for k, v in p.items()}, "square": {k: np.zeros_like(v) for k, v in p.items()},
            "rng": np.random.default_rng(seed), "order": []}


def worst_windows(state: dict, b: Batch) -> Batch:
    """The window of each document that the present model finds worst, at first the one with most hints."""
    x, row = _vectors(state["p"], state["vocabulary"], b)
    if state["step"] == 0:
        score = np.append(np.append(np.float32(0), state["hint"])[row], np.float32(0))[b.index].sum(axis=1, dtype=np.float32)
    else:
        tables = project(state["p"], x)
        score = np.concatenate([logits(state["p"], tables, b.index[i:i + 4096], len(b.hashes))
                                for i in range(0, len(b.index), 4096)])
    by = np.lexsort((score, b.doc))
    return windows_of(b, by[np.append(np.flatnonzero(np.diff(b.doc[by])), len(by) - 1)])


def learn(state: dict, b: Batch, labels: np.ndarray, *, steps: int = 500, batch: int = 128, rate: float = 0.01,
          unknown: float = 0.2) -> None:
    """Three passes over one window a document, or as far as ``steps`` go."""
    p, mean, square, rng, order = (state[k] for k in ("p", "mean", "square", "rng", "order"))
    n_bad, n_good = labels.sum(), len(labels) - labels.sum()
    cost = np.where(labels > 0, np.sqrt(min(16.0, max(1.0, n_good / max(1.0, n_bad)))), 1.0)
    first = state["step"]
    state["step"] = min(steps, first + 3 * -(-len(labels) // batch))
    for step in range(first, state["step"]):
        if len(order) < batch:
            order = [*order, *rng.permutation(len(labels)).tolist()]
        own, order = np.array(order[:batch]), order[batch:]
        small = windows_of(b, own)  # only the batch's own words take part
        hide = rng.random(len(small.hashes)) < unknown  # some words are treated as unknown, as many will be
        _, g = gradients(p, state["vocabulary"], small, small.index, labels[own].astype(np.float32),
                         cost[own].astype(np.float32), hide)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        for k, v in g.items():
            v = v * min(1.0, 1.0 / (norm + 1e-9)) + 1e-5 * p[k]
            mean[k] = 0.9 * mean[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v * v
            fix = np.sqrt(1 - 0.99 ** (step + 1)) / (1 - 0.9 ** (step + 1))
            p[k] -= (rate * min(1.0, 2 * (steps - step) / steps) * fix * mean[k] / (np.sqrt(square[k]) + 1e-6)).astype(np.float32)
    state["order"] = order


def _repeated(b: Batch, times: np.ndarray) -> Batch:
    return b._replace(index=np.repeat(b.index, times, axis=0), doc=np.repeat(b.doc, times))


def held_out(doc_id: Column, folds: int = 3) -> Column:
    """Rows of fold 1, from which nothing is learned."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 1


def training_sample(docs: DataFrame, labels: DataFrame, *, sample_docs: int = 6000, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """At most ``sample_docs`` labelled texts outside the held-out fold, in hash order: (place, toxic, times, text).

    Equal texts of an id are one row that counts ``times``.
    """
    learn = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    learn = learn.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), whole(F.col(text_col)).alias("text"))
    n_bad = sample_docs // 3
    chosen = [learn.where(rule).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
              for rule, n in ((F.col("toxic") == 1, n_bad), (F.col("toxic") != 1, sample_docs - n_bad))]
    few = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("of"), "toxic")
    digest = F.xxhash64("text")
    rows = (texts.join(F.broadcast(few), texts.id == few.of)  # ids may repeat; no text is moved here
            .select("of", digest.alias("digest"), (F.col("toxic") == 1).alias("toxic"))
            .orderBy(F.xxhash64("of"), "of", "digest").limit(sample_docs))
    times: dict[tuple, int] = {}
    for r in rows.collect():
        times[tuple(r)] = times.get(tuple(r), 0) + 1
    places = docs.sparkSession.createDataFrame(
        [(i, *r, n) for i, (r, n) in enumerate(times.items())],
        StructType([StructField("place", LongType()), *rows.schema.fields, StructField("times", LongType())]))
    return (texts.join(F.broadcast(places), (texts.id == places.of) & (digest == places.digest))
            .select("place", "toxic", "times", "text").dropDuplicates(["place"]))


def score_texts(frame: DataFrame, vocabulary: np.ndarray, params: dict[str, np.ndarray], *, with_text: bool = False) -> DataFrame:
    """``score`` of every whole text, from rows (what to keep, text) to (what to keep, the text if asked for, score)."""
    model = frame.sparkSession.sparkContext.broadcast((vocabulary, params))
    kept = frame.columns[:1 + with_text]
    schema = frame.select(kept).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        words, p = model.value
        for b in batches_of(batches, 1):
            x = batch_of(b.column(1))
            tables, score = project(p, _vectors(p, words, x)[0]), np.zeros(b.num_rows)
            logit = np.empty(len(x.index), np.float32)
            full = x.index[:, -1] < len(x.hashes)
            for part in (np.flatnonzero(full), np.flatnonzero(~full)):
                for i in range(0, len(part), 2048):
                    own = part[i:i + 2048]
                    logit[own] = logits(p, tables, x.index[own], len(x.hashes))
            np.maximum.at(score, x.doc, _sigmoid(logit))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], pa.array(score)], [*kept, "score"])
            del b, x, tables
        give_back()

    return frame.mapInArrow(run, schema)


_STATE = "kind string, payload binary"
_MODEL = ("vocabulary", "hint", "p", "step")  # what picking windows takes; the rest is the optimiser's


def _state_rows(state: dict) -> pa.RecordBatch:
    parts = ({k: state[k] for k in _MODEL}, {k: v for k, v in state.items() if k not in _MODEL})
    return pa.RecordBatch.from_arrays([pa.array(["model", "memory"]), pa.array([pickle.dumps(x) for x in parts], pa.binary())],
                                      ["kind", "payload"])


def _count(least_docs: int, sample: DataFrame) -> DataFrame:
    """(word, have, bad) of the words of at least ``least_docs`` sampled documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in batches_of(batches, 3):
            b = batch_of(s.column(3))
            have, bad = count_words(b, s.column(1).to_numpy(False).astype(np.float64), s.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (
                b.hashes, have.astype(np.int64), bad.astype(np.int64))], ["word", "have", "bad"])

    return (sample.mapInArrow(run, "word long, have long, bad long").groupBy("word")
            .agg(F.sum("have").alias("have"), F.sum("bad").alias("bad")).where(F.col("have") >= least_docs))


def _first(n_bad: int, n_good: int):
    """The state before the first step, from all known words; a row of -1 documents is no word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        if rows.num_rows:
            words, have, bad = (rows.column(i).to_numpy() for i in range(3))
            by = np.argsort(words.view(_U))
            by = by[have[by] >= 0]
            yield _state_rows(first_state(words.view(_U)[by], have[by].astype(np.float64), bad[by].astype(np.float64), n_bad, n_good))

    return run


def _pick(model):
    """The worst window of each sampled document, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        state = None
        for s in batches_of(batches, 3):
            state = state or pickle.loads(model.value)
            b = worst_windows(state, batch_of(s.column(3)))
            rows = []
            for i in range(len(b.index)):
                w = merged(windows_of(b, np.array([i])))
                rows.append(pack(w.hashes, np.diff(w.cuts), w.grams, w.share, w.opens.reshape(-1), w.index[0]))
            yield pa.RecordBatch.from_arrays([*s.columns[:3], pa.array([None] * len(rows), pa.string()), pa.array(rows, pa.binary())],
                                             ["place", "toxic", "times", "kind", "payload"])
            del s, b, rows
        give_back()

    return run


def _fit(steps: int, batch: int):
    """Learns from one window a document; the state stands before the windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, parts, toxic, times = {}, [], [], []
        for s in batches:
            for label, n, kind, payload in zip(*(s.column(i).to_pylist() for i in range(1, 5))):
                if kind is not None:
                    state |= pickle.loads(payload)
                    continue
                hashes, size, grams, share, opens, index = unpack(payload)
                toxic.append(label)
                times.append(n)
                parts.append(Batch(hashes.astype(_U), grams.astype(np.int32), share,
                                   np.concatenate([[0], np.cumsum(size.astype(np.int64))]),
                                   opens.reshape(-1, len(OPENINGS)).astype(np.int32),
                                   index.reshape(1, -1).astype(np.int32), np.zeros(1, np.int64)))
        if parts:
            windows = joined(parts)
            parts.clear()
            learn(state, _repeated(windows, np.array(times)), np.repeat(np.array(toxic, np.float64), times), steps=steps, batch=batch)
            yield _state_rows(state)
            del windows, state
            give_back()

    return run


def trained(docs: DataFrame, labels: DataFrame, *, steps: int = 500, batch: int = 128, least_docs: int = 3, id_col: str = "doc_id",
            text_col: str = "text", **sample) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The network learnt from a bounded sample; without any labelled row all its numbers are 0."""
    spark = docs.sparkSession
    few = save(training_sample(docs, labels, id_col=id_col, text_col=text_col, **sample), "toxicity-sample")
    n, n_all, n_bad = few.agg(F.count("*"), F.sum("times"), F.sum(F.col("times") * F.col("toxic").cast("long"))).first()
    if not n:
        return np.empty(0, _U), {k: np.zeros_like(v) for k, v in new_params(0, np.empty(0)).items()}
    none = spark.range(1).select(F.lit(0).cast("long").alias("word"), F.lit(-1).cast("long").alias("have"), F.lit(0).cast("long").alias("bad"))
    words = _count(least_docs, few).unionByName(none).repartition(1)
    state = save(words.mapInArrow(_first(n_bad, n_all - n_bad), _STATE), "toxicity-state")
    for _ in range(-(-steps // (3 * -(-n_all // batch)))):
        given = spark.sparkContext.broadcast(bytes(state.where("kind = 'model'").first().payload))
        windows = few.mapInArrow(_pick(given), "place long, toxic boolean, times long, kind string, payload binary")
        before = state.select(F.lit(-1).cast("long").alias("place"), F.lit(None).cast("boolean").alias("toxic"),
                              F.lit(None).cast("long").alias("times"), "kind", "payload")
        rows = windows.unionByName(before).orderBy("place").limit(n + 2)  # all of them, in one task
        after = save(rows.mapInArrow(_fit(steps, batch), _STATE), "toxicity-state")
        given.destroy()
        remove_table(state)
        state = after
    rows = windows = before = after = None
    release(spark)  # once: however few texts a round has, all rounds together shuffle about ``steps`` batches of windows
    model = pickle.loads(bytes(state.where("kind = 'model'").first().payload))
    remove_table(state)
    remove_table(few)
    return model["vocabulary"], model["p"]


def score_documents(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id",
                    text_col: str = "text", **kwargs) -> DataFrame:
    """The id, ``held_out``, ``score`` and ``predicted`` of every document."""
    model = trained(docs, labels, id_col=id_col, text_col=text_col, **kwargs)
    scored = score_texts(docs.select(F.col(id_col), whole(F.col(text_col)).alias("text")), *model)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id",
               text_col: str = "text", **kwargs) -> DataFrame:
    """The documents that are not predicted to be toxic, with their own columns."""
    model = trained(docs, labels, id_col=id_col, text_col=text_col, **kwargs)
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text_col], F.col(text_col).isNull().alias(" none"))  # the text goes once
    scored = score_texts(docs.select(rest.alias("rest"), whole(F.col(text_col)).alias("text")), *model, with_text=True)
    text = F.when(~F.col("rest")[" none"], F.col("text"))
    return scored.where(F.col("score") < threshold).select(*[
        text.alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns])
