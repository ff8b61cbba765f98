"""Main text of HTML pages by a linear-chain conditional random field (operator 11).

1. *Blocks.*  A page falls into the leaf blocks of its DOM (``html_blocks``), in page
   order; scripts, styles, heads and other elements without text fall away there.
2. *Model.*  Each block is article or not.  A block's score comes from the tags and
   names (class, id, role) of its ancestors and from its text (length, share of links,
   punctuation, words of short blocks) and from how much text its element holds;
   further weights score pairs of neighbouring labels, apart for neighbours within one
   element and across elements, so a short paragraph among paragraphs goes with them.
3. *Training.*  The weights maximise the likelihood of labelled pages with an L2
   penalty: forward-backward over all pages at once in numpy, a hundred and twenty steps.  By
   default the labelled pages are 1600 of ``html_layouts``; a caller may give own ones,
   whose elements are marked ``data-main="1"`` or ``"0"``.
4. *Decoding.*  Tasks read pages one after the other, and Viterbi finds the best labels.

The driver holds the labelled pages and a few thousand weights, whatever the table's
size; a page is read by the task that holds its row, and nothing is shuffled.

Defined cases: null html counts as empty; a page without article blocks has an empty
text; white space is what ``str.split`` takes for it.  Repeated rows, null ids and urls
pass through; further columns are not returned.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .html_blocks import blocks_of, clean, features_of, path_features, same_home, text_features
from .html_layouts import labelled_pages


class Model(NamedTuple):
    features: dict[str, int]
    weights: np.ndarray      # score of "article" minus score of "other", per feature
    start: np.ndarray        # of the first label
    step: np.ndarray         # of a pair of labels, for blocks of different elements and of the same


class Chains(NamedTuple):
    """Pages as runs of blocks, blocks as runs of feature numbers."""
    ids: np.ndarray
    at: np.ndarray           # where a block's features begin, and their number at the end
    first: np.ndarray        # where a page's blocks begin, and their number at the end


def _chains(pages: list[list[set[str]]], features: dict[str, int]) -> Chains:
    ids, at, first = [], [0], [0]
    for page in pages:
        for block in page:
            ids.extend(sorted(features[f] for f in block if f in features))
            at.append(len(ids))
        first.append(len(at) - 1)
    return Chains(np.array(ids, np.int64), np.array(at), np.array(first))


def _emissions(chains: Chains, weights: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[chains.ids])])
    return total[chains.at[1:]] - total[chains.at[:-1]]


def likelihood(score: np.ndarray, label: np.ndarray, same: np.ndarray, size: np.ndarray, start: np.ndarray, step: np.ndarray):
    """(log likelihood, d score, d start, d step) of pages x blocks, by forward-backward.

    ``score`` is what "article" scores above "other", ``same`` tells which step weights lead to a block;
    the pages stand in order of their ``size``, longest first.
    """
    pages, n = score.shape
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(n + 1)]  # pages of more than t blocks
    emit = np.stack([np.zeros_like(score), score])
    ahead, back = np.zeros((n, 2, pages)), np.zeros((n, 2, pages))
    ahead[0] = start[:, None] + emit[:, :, 0]
    total = np.empty(pages)
    for t in range(n):
        m = live[t]
        if t:
            w = step[same[:m, t]]
            for x in (0, 1):
                ahead[t, x, :m] = np.logaddexp(ahead[t - 1, 0, :m] + w[:, 0, x], ahead[t - 1, 1, :m] + w[:, 1, x]) + emit[x, :m, t]
        ends = slice(live[t + 1], m)
        total[ends] = np.logaddexp(ahead[t, 0, ends], ahead[t, 1, ends])
    d_step, known = np.zeros((2, 2, 2)), 0.0
    for t in range(n - 1, 0, -1):
        m = live[t]
        w = step[same[:m, t]]
        for x in (0, 1):
            move = [w[:, x, y] + emit[y, :m, t] + back[t, y, :m] for y in (0, 1)]
            back[t - 1, x, :m] = np.logaddexp(*move)
            for y in (0, 1):
                pairs = (label[:m, t - 1] == x) & (label[:m, t] == y)
                d_step[:, x, y] += np.bincount(same[:m, t], pairs - np.exp(ahead[t - 1, x, :m] + move[y] - total[:m]), 2)
                known += (w[:, x, y] * pairs).sum()
    p = np.exp(ahead[:, 1] + back[:, 1] - total).T
    there = np.arange(n) < size[:, None]
    d_start = np.bincount(label[:, 0], minlength=2) - np.array([(1 - p[:, 0]).sum(), p[:, 0].sum()])
    known += start[label[:, 0]].sum() + (score * label)[there].sum()
    return known - total.sum(), np.where(there, label - p, 0.0), d_start, d_step


def fit(pages: Iterable[str], *, steps: int = 120, rate: float = 0.1, penalty: float = 1.0, least: int = 6) -> Model:
    """Weights learnt from labelled pages; features of fewer than ``least`` pages are left out."""
    read = [(features_of(blocks), [int(b.label == "1") for b in blocks], same_home(blocks)) for blocks in map(blocks_of, pages) if blocks]
    read.sort(key=lambda page: -len(page[0]))
    count: dict[str, int] = {}
    for page, _, _ in read:
        for f in set().union(*page):
            count[f] = count.get(f, 0) + 1
    features = {f: i for i, f in enumerate(sorted(f for f, n in count.items() if n >= least))}
    chains = _chains([page for page, _, _ in read], features)
    sizes = np.diff(chains.first)
    there = np.arange(sizes.max())[None] < sizes[:, None]
    label = np.zeros(there.shape, np.int64)
    same = label.copy()
    label[there] = [x for _, labels, _ in read for x in labels]
    same[there] = [x for _, _, homes in read for x in homes]
    rows = np.repeat(np.arange(len(chains.at) - 1), np.diff(chains.at))
    values = {"weights": np.zeros(len(features)), "start": np.zeros(2), "step": np.zeros((2, 2, 2))}
    mean = {k: np.zeros_like(v) for k, v in values.items()}
    spread = {k: np.zeros_like(v) for k, v in values.items()}
    for t in range(1, steps + 1):
        score = np.zeros(there.shape)
        score[there] = _emissions(chains, values["weights"])
        _, d_score, d_start, d_step = likelihood(score, label, same, sizes, values["start"], values["step"])
        grads = {"weights": np.bincount(chains.ids, d_score[there][rows], len(features)), "start": d_start, "step": d_step}
        for k, v in values.items():
            g = grads[k] - penalty * v
            mean[k] = 0.9 * mean[k] + 0.1 * g
            spread[k] = 0.99 * spread[k] + 0.01 * g * g
            v += rate * (mean[k] / (1 - 0.9 ** t)) / (np.sqrt(spread[k] / (1 - 0.99 ** t)) + 1e-8)
    return Model(features, values["weights"], values["start"], values["step"])


@lru_cache(maxsize=1)
def default_model() -> Model:
    return fit(labelled_pages())


def viterbi(score: np.ndarray, same: list[bool], start: np.ndarray, step: np.ndarray) -> list[int]:
    """The best labels of a page."""
    if not len(score):
        return []
    (a, b), steps = start.tolist(), step.tolist()
    out, into, came = a, b + float(score[0]), []
    for s, alike in zip(score[1:].tolist(), same[1:]):
        (oo, oi), (io, ii) = steps[alike]
        from_o, from_i = into + io > out + oo, into + ii > out + oi
        came.append((int(from_o), int(from_i)))
        out, into = (into + io if from_o else out + oo), (into + ii if from_i else out + oi) + s
    labels = [int(into > out)]
    for back in reversed(came):
        labels.append(back[labels[-1]])
    return labels[::-1]


class Extractor:
    """A model at work; it remembers the scores of the paths it met last, as pages of a site share them."""

    def __init__(self, model: Model, remembered: int = 10_000) -> None:
        self.model, self.remembered = model, remembered
        self.weight = dict(zip(model.features, model.weights.tolist()))
        self.paths: dict[tuple, float] = {}

    def _path(self, path: tuple) -> float:
        if path not in self.paths:
            if len(self.paths) >= self.remembered:
                self.paths.clear()
            self.paths[path] = sum(self.weight.get(f, 0.0) for f in sorted(path_features(path)))
        return self.paths[path]

    def scores(self, blocks: list) -> np.ndarray:
        get = self.weight.get
        return np.array([self._path(b.path) + sum([get(f, 0.0) for f in sorted(own)]) for b, own in zip(blocks, text_features(blocks))])

    def labels(self, blocks: list) -> list[int]:
        return viterbi(self.scores(blocks), same_home(blocks), self.model.start, self.model.step)

    def main_text(self, html: str) -> str:
        """The article of one page."""
        blocks = blocks_of(html)
        return "\n\n".join(clean(b.text) for b, keep in zip(blocks, self.labels(blocks)) if keep)


def _extracted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(model.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [extractor.main_text(html) for html in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    return run


def extract_main_text(pages: DataFrame, *, model: Model | None = None, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars (code points)."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(_extracted(shared), f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
