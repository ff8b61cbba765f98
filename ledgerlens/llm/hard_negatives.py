"""Hard negatives by Fagin's threshold algorithm (operator 12).

Vectors become integers floor(scale * x); a row's score is its inner product with an
anchor.  An anchor's positives are its best other rows of its label; for each positive
the best rows of other labels whose score lies in a window below the positive's are its
hard negatives.  Better is: higher score, then smaller id.

1. *Blocks.*  Rows fall by hash into blocks of about ``block`` rows, anchors (a stated
   query set) into groups; a task works a tile, one block with one group.
2. *Lists.*  Per dimension a tile holds its rows sorted by component.
3. *Threshold algorithm.*  An anchor goes down every list at once, from the top where its
   own component is positive and from the bottom where it is negative.  Rows met for the
   first time get their whole integer score (random access).  The threshold, the sum of
   the anchor's products with the values last met, bounds the score of every row not yet
   met, so an anchor stops once it falls strictly below the k-th score of each of its
   windows, or below the window itself where that has not got k rows; ties are thus met.
4. *Merge.*  A tile returns at most k rows per anchor and window; the best k of all tiles
   are ranked per (anchor, positive).

The positives run first, as one window without bounds; their scores set the negatives'
windows.  No tile, group or result depends on how many rows share a label or a vector.

Defined cases: a null label, a null vector, a null or non-finite component: the row takes
no part.  Rows are told apart as rows, so a repeated id is an anchor, positive or negative
of its own; a null id comes last among ties and is no anchor.  Only rows with equally many
components are compared (without any, all scores are 0).  An anchor without positives, a
window without rows and an empty table give no rows.  A component of 2**31 or more after
scaling, or a product that may not fit into 64 bits, raises OverflowError.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .exact import dot, floors, pack, unpack, whole_and_finite
from .storage import save

_FOUND = "anchor long, slot int, id long, score long"
_OPEN = 2 ** 63 - 1  # windows without bounds


class Lists:
    """The rows of a block, with their order in every dimension."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.met = 0  # rows scored so far, over all anchors

    def best(self, a: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int,
             windows: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (low, high): rows and scores of the best ``k`` allowed rows within it, in order."""
        n, up, down = len(self.x), np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        seen, score = np.zeros(n, bool), np.zeros(n, np.int64)
        open_ = [i for i, (low, high) in enumerate(windows) if low <= high]
        at, step = 0, 16
        if not len(up) + len(down):  # no list says anything: all scores are 0
            seen[:] = True
            open_ = []
        while open_ and at < n:
            z = min(n, at + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[n - z:n - at, up]] = True
            fresh[self.order[at:z, down]] = True
            fresh = np.flatnonzero(fresh & ~seen)
            seen[fresh] = True
            score[fresh] = dot(self.x[fresh], a)
            self.met += len(fresh)
            # values last met, in all lists: no row still unseen scores more
            bound = (int((self.x[self.order[n - z, up], up] * a[up]).sum())
                     + int((self.x[self.order[z - 1, down], down] * a[down]).sum()))
            known = score[seen & allowed]
            still = []
            for i in open_:
                low, high = windows[i]
                own = known[(known >= low) & (known <= high)]
                least = int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else low
                if bound >= least:
                    still.append(i)
            open_, at, step = still, z, 2 * step
        out = []
        for low, high in windows:
            rows = np.flatnonzero(seen & allowed & (score >= low) & (score <= high))
            rows = rows[np.lexsort((ids[rows], -score[rows]))[:k]]
            out.append((rows, score[rows]))
        return out


def _packed(scale: int):
    """(row, id, label, anchor, v) with the vector as packed integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, at = floors(b.column(4), scale, 2 ** 31)
            dims = np.diff(at)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(dims.astype(np.int32)),
                 pa.array([pack(x[s:s + n]) for s, n in zip(at[:-1], dims)], pa.binary())],
                ["row", "id", "label", "anchor", "dim", "x"])

    return run


def _tile(k: int, same: bool, low: int, high: int) -> Callable[[pa.Table], pa.Table]:
    """One block of rows with one group of anchors."""
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        x = np.array([unpack(raw, dim) for raw in table.column("x").to_pylist()], np.int64).reshape(len(asks), dim)
        row, labels = table.column("row").to_numpy(), np.array(table.column("label").to_pylist(), object)
        own = np.flatnonzero(~asks)
        # a null id stands behind all others
        ids = np.array([_OPEN if v is None else v for v in table.column("id").to_pylist()], np.int64)[own]
        lists, found = Lists(x[own]), []
        wanted = table.column("positives").to_pylist()
        by_label = {v: labels[own] == v for v in set(labels[asks])}
        for q in np.flatnonzero(asks):
            like = by_label[labels[q]]
            if same:
                results = lists.best(x[q], like & (row[own] != row[q]), ids, k, [(-_OPEN, _OPEN)])
            else:  # low % of the positive's score <= score <= high % of it, in integers
                results = lists.best(x[q], ~like, ids, k, [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in wanted[q]])
            for slot, (rows, score) in enumerate(results):
                found.append((np.full(len(rows), row[q]), np.full(len(rows), slot, np.int32), rows, score))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 4
        picked = own[columns[2].astype(np.int64)]
        return pa.table({"anchor": pa.array(columns[0].astype(np.int64)), "slot": pa.array(columns[1].astype(np.int32)),
                         "id": table.column("id").take(pa.array(picked)), "score": pa.array(columns[3].astype(np.int64))})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   block: int = 8192, group: int = 1024) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows ask; a window reaches from ``low`` to ``high`` percent of the positive's score.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = save(rows.where(F.col("label").isNotNull() & whole_and_finite(F.col("v")))
                .mapInArrow(_packed(scale), "row long, id long, label string, anchor boolean, dim int, x binary"), "negative-rows")
    n = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks, groups = -(-n["rows"] // block) or 1, -(-n["anchors"] // group) or 1
    seat = F.xxhash64("row")
    part = rows.select("row", "id", "label", "dim", "x", F.lit(False).alias("asks"), F.pmod(seat, F.lit(blocks)).alias("b"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
    asking = rows.where("anchor").select("row", "id", "label", "dim", "x", F.lit(True).alias("asks"), F.pmod(seat, F.lit(groups)).alias("g"))

    def tiles(asking: DataFrame, k: int, same: bool) -> DataFrame:
        spread = asking.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        all_ = part.withColumn("positives", F.lit(None).cast(spread.schema["positives"].dataType)).unionByName(spread)
        return all_.groupBy("dim", "g", "b").applyInArrow(_tile(k, same, low, high), _FOUND)

    none = F.lit(None).cast("array<struct<id:long,score:long>>")
    best = _best(tiles(asking.withColumn("positives", none), positives, True), positives)
    # at most ``positives`` per anchor, in their order
    best = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    best = save(best.select(F.col("anchor").alias("row"), F.transform("p", lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score")))
                            .alias("positives")), "positives")
    asked = asking.join(best, "row")
    out = _best(tiles(asked, negatives, False), negatives)
    own = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "positives")
    picked = F.element_at("positives", F.col("slot") + 1)
    return out.join(own, "anchor").select("anchor_id", picked["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                                          F.col("id").alias("negative_id"), picked["score"].alias("positive_score"),
                                          F.col("score").alias("negative_score"))
