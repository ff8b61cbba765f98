"""Centroid clustering by dimension-sharded Lloyd rounds (operator 13).

1. *Shards.*  Vectors become integers floor(scale * x) and are cut into chunks of at
   most ``chunk`` vectors and ``shards`` blocks of columns; the table of slices
   (chunk, shard, integers) is partitioned by shard.
2. *Partial distances.*  The tasks of a column block compute, exactly, what its columns
   add to the squared distances between a chunk's vectors and its slice of the centroids.
3. *Reduce by key.*  The blocks of a chunk are added up; the nearest centroid is the
   first least sum, so ties go to the smaller number.
4. *Update.*  Each shard joins the assignment to its own slices and sums its columns per
   cluster, first within a task, then by key; its slice of a centroid becomes the exact
   floor(sum / count).  A centroid without vectors stays.

The driver hands on k x dim centroid components a round and nothing else.  A chunk is a
few hundred kilobytes whatever the table's size, a cluster may hold all rows, and each
round starts from the written slices, so a lost executor costs one round at most.

Defined cases: a vector that is null, of another length than ``dim``, or holds null or
non-finite components takes no part and is not returned.  Repeated ids are vectors of
their own (of equal hashes the lesser vector comes first); a null id starts no centroid
unless too few others are there.  With fewer than k vectors there are as many centroids.
No rows give no rows.  A component of 2**27 or more after scaling raises OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .exact import dot, floors, pack, unpack, whole_and_finite
from .storage import save

_LIMIT = 2 ** 27
_IDS = -1  # the "shard" whose rows hold the ids of a chunk
_PARTIAL = "chunk long, n int, part binary"
_NEAREST = "chunk long, n int, cluster binary, distance binary"
_SUMS = "shard int, cluster int, n long, sums array<long>"


def _cuts(dim: int, shards: int) -> np.ndarray:
    return np.linspace(0, dim, min(shards, dim) + 1).astype(int)


def _sliced(dim: int, shards: int, chunk: int, scale: int):
    """Vectors (id, v) to slices (chunk, n, ids, slice, shard)."""
    cuts = _cuts(dim, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                part = b.slice(at, chunk)
                x = floors(part.column(1), scale, _LIMIT)[0].reshape(-1, dim)
                n, blocks = len(x), [pack(x[:, a:z]) for a, z in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * (1 + len(blocks)), pa.int64()), pa.array([n] * (1 + len(blocks)), pa.int32()),
                    pa.array([part.column(0).to_pylist(), *[None] * len(blocks)], pa.list_(part.schema.field(0).type)),
                    pa.array([None, *blocks], pa.binary()),
                    pa.array([_IDS, *range(len(blocks))], pa.int32())], ["chunk", "n", "ids", "slice", "shard"])
                key += 1

    return run


def _partials(centres: list[np.ndarray]):
    """What each column block adds to the squared distances (vectors x centroids of a chunk)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, shard, n, raw in zip(*(b.column(c).to_pylist() for c in ("chunk", "shard", "n", "slice"))):
                c = centres[shard]
                x = unpack(raw, n * c.shape[1]).reshape(n, -1)
                part = (x * x).sum(axis=1)[:, None] - 2 * dot(x, c.T) + (c * c).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([n], pa.int32()),
                                                  pa.array([pack(part)], pa.binary())], ["chunk", "n", "part"])

    return run


def _nearest(k: int):
    """Adds the column blocks of a chunk and takes the first least distance."""
    def run(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        total = sum(unpack(raw, n * k) for raw in table.column("part").to_pylist()).reshape(n, k)
        own = total.argmin(axis=1)
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "n": pa.array([n], pa.int32()),
                         "cluster": pa.array([pack(own)], pa.binary()),
                         "distance": pa.array([pack(total[np.arange(n), own])], pa.binary())})

    return run


def _sums(k: int, widths: list[int]):
    """A task's sums per (shard, cluster) over the chunks it sees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        count: dict[int, np.ndarray] = {}
        for b in batches:
            for shard, n, raw, cluster in zip(*(b.column(c).to_pylist() for c in ("shard", "n", "slice", "cluster"))):
                own = unpack(cluster, n)
                x = unpack(raw, n * widths[shard]).reshape(n, -1)
                if shard not in total:
                    total[shard], count[shard] = np.zeros((k, widths[shard]), np.int64), np.zeros(k, np.int64)
                np.add.at(total[shard], own, x)
                count[shard] += np.bincount(own, minlength=k)
        rows = [(s, c, int(count[s][c]), total[s][c].tolist()) for s in total for c in range(k) if count[s][c]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(col, kind) for col, kind in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], ["shard", "cluster", "n", "sums"])

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks (ids, n, cluster, distance) to a row per vector."""
    for b in batches:
        for ids, n, cluster, distance in zip(*(b.column(c).to_pylist() for c in ("ids", "n", "cluster", "distance"))):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(unpack(cluster, n).astype(np.int32)),
                                              pa.array(unpack(distance, n))], ["id", "cluster", "distance"])


def lloyd(vectors: DataFrame, *, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, shards: int = 4,
          chunk: int = 4096, seed: str = "1", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector that takes part: id, cluster, distance, cluster_inertia, inertia, centroid (array of long)."""
    spark = vectors.sparkSession
    kept = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(whole_and_finite(F.col("v")) & (F.size("v") == dim)))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").toArrow().column("v")
    centres = floors(first, scale, _LIMIT)[0].reshape(-1, dim)
    if not len(centres):
        return spark.createDataFrame([], f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    cuts = _cuts(dim, shards)
    table = save(kept.mapInArrow(_sliced(dim, shards, chunk, scale), "chunk long, n int, ids array<long>, slice binary, shard int"),
                 "slices", ("shard",))
    slices = table.where(F.col("shard") != _IDS).select("chunk", "shard", "n", "slice")

    def assigned(centres: np.ndarray) -> DataFrame:
        blocks = [centres[:, a:z] for a, z in zip(cuts[:-1], cuts[1:])]
        return (slices.mapInArrow(_partials(blocks), _PARTIAL).groupBy("chunk")
                .applyInArrow(_nearest(len(centres)), _NEAREST))

    for _ in range(rounds):
        own = assigned(centres).select("chunk", "cluster")
        sums = slices.join(own, "chunk").mapInArrow(_sums(len(centres), np.diff(cuts).tolist()), _SUMS)
        total = (sums.select("shard", "cluster", "n", F.posexplode("sums").alias("j", "s"))
                 .groupBy("shard", "cluster", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
        centres = centres.copy()
        for r in total.select("shard", "cluster", "j", F.expr("(s - pmod(s, n)) div n").alias("value")).collect():
            centres[r.cluster, cuts[r.shard] + r.j] = r.value
    last = save(assigned(centres), "nearest")
    ids = table.where(F.col("shard") == _IDS).select("chunk", "ids")
    rows = save(last.join(ids, "chunk").mapInArrow(_rows, "id long, cluster int, distance long"), "clustered")
    inertia = {r.cluster: r.inertia for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    whole = sum(inertia.values())
    per = spark.createDataFrame([(c, i, whole, centres[c].tolist()) for c, i in inertia.items()],
                                "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return (rows.join(F.broadcast(per), "cluster")  # k rows
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid"))
