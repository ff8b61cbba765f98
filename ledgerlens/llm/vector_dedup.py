"""Near duplicates of vectors by product quantisation (operator 7).

Vectors of one label link when their cosine is at least ``threshold``.

1. Equal vectors of one label are one class, which takes part once with its size.
2. *Index.*  On at most ``sample`` classes (by hash order) numpy learns the centres
   of the inverted lists and, for the residuals, ``parts`` codebooks.  Every class is
   then indexed: list, code, and the length of what the code leaves out.
3. *Probes.*  Unit vectors of the threshold's cosine lie within r = sqrt(2 - 2 t).  A
   vector probes each list whose border it can cross within r (distance to the
   plane between the two centres), which is sufficient for every link; of a pair
   the vector of the lower list does.
4. *Table lookups.*  Within a list, a query's distances to the code words of each
   part are tabled once; sums of entries give its distance d to a coded vector, and
   only if d <= r + error of that code can the two link.
5. *Exact rerank.*  Those pairs get their cosine in double precision.

A cell (label, list) is worked in tiles of bounded numbers of queries and indexed
vectors, so one dense cell spreads over many tasks.  A tile returns the linked
weight of each of its vectors and a spanning forest of its links, never its pairs.

Defined cases: null label; null, empty or zero vector; a null or non-finite
component: such rows link with nothing.  Vectors of a rarer length are compared
exactly among themselves.  Repeated ids are rows of their own; a null id is never
the least of a component unless it is alone.  No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .storage import save

_TILE = 4096
_POSTED = "label string, list int, side int, c long, size long, vector binary, code binary, error double"
_FOUND = "c long, weight long, root long"


def k_means(x: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Centres of at most k clusters."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i:i + 8192] @ centres.T - half, axis=1) for i in range(0, len(x), 8192)])


class Index:
    """Coarse centres and residual codebooks, learnt on a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int = 8, words: int = 64) -> None:
        self.centres = k_means(sample, lists)
        self.cuts = np.linspace(0, sample.shape[1], min(parts, sample.shape[1]) + 1).astype(int)
        rest = sample - self.centres[nearest(sample, self.centres)]
        self.books = [k_means(rest[:, a:z], words) for a, z in zip(self.cuts[:-1], self.cuts[1:])]
        self.apart = np.stack([np.sqrt(((self.centres - c) ** 2).sum(axis=1)) for c in self.centres])

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, code, length of the error) of unit vectors."""
        own = nearest(x, self.centres)
        rest = x - self.centres[own]
        code = np.empty((len(x), len(self.books)), np.uint8)
        for m, (book, a, z) in enumerate(zip(self.books, self.cuts[:-1], self.cuts[1:])):
            code[:, m] = nearest(rest[:, a:z], book)
        return own, code, np.sqrt(((x - self.decode(own, code)) ** 2).sum(axis=1))

    def decode(self, own: np.ndarray, code: np.ndarray) -> np.ndarray:
        return self.centres[own] + np.hstack([book[code[:, m]] for m, book in enumerate(self.books)])

    def probes(self, x: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
        """Vectors x lists: which lists may hold a vector within ``radius``."""
        far = ((x * x).sum(axis=1)[:, None] - 2 * x @ self.centres.T + (self.centres ** 2).sum(axis=1))
        gap = far - far[np.arange(len(x)), own][:, None]
        return gap <= 2 * radius * self.apart[own] + 1e-9

    def lookup(self, x: np.ndarray, at: int, code: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the coded vectors of list ``at``, by table."""
        rest, total = x - self.centres[at], np.zeros((len(x), len(code)))
        for m, (book, a, z) in enumerate(zip(self.books, self.cuts[:-1], self.cuts[1:])):
            part = rest[:, a:z]
            table = (part * part).sum(axis=1)[:, None] - 2 * part @ book.T + (book * book).sum(axis=1)
            total += table[:, code[:, m]]
        return total


def _units(column: pa.Array, dim: int) -> np.ndarray:
    x = np.array(column.to_pylist(), np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _post(model, radius: float):
    """Classes (c, label, size, dim, v) to a posting in their own list and queries to all lists probed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, main = model.value
        for b in batches:
            dims = b.column(3).to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                x = _units(part.column(4), int(dim))
                c, size = part.column(0).to_numpy(), part.column(2).to_numpy()
                label = np.array(part.column(1).to_pylist(), object)
                raw = [v.tobytes() for v in x]
                if dim == main:
                    own, code, error = index.encode(x)
                    # of two linked vectors the one of the lower list probes the other's
                    q, at = np.nonzero(index.probes(x, own, radius) & (np.arange(len(index.centres)) >= own[:, None]))
                    codes = [v.tobytes() for v in code]
                else:  # of a rarer length: one list of their own, compared without codes
                    own, error = np.full(len(x), -int(dim)), np.full(len(x), np.inf)
                    q, at, codes = np.arange(len(x)), own, [b""] * len(x)
                home = np.arange(len(x))
                for rows, lists, side in ((home, own, np.zeros(len(x))), (q, at, 1 + (at > own[q]))):
                    for i in range(0, len(rows), 20_000):
                        r = rows[i:i + 20_000]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(label[r], pa.string()), pa.array(lists[i:i + 20_000].astype(np.int32)),
                            pa.array(side[i:i + 20_000].astype(np.int32)), pa.array(c[r]), pa.array(size[r]),
                            pa.array([raw[k] for k in r], pa.binary()), pa.array([codes[k] for k in r], pa.binary()),
                            pa.array(error[r])],
                            ["label", "list", "side", "c", "size", "vector", "code", "error"])

    return run


def _tile(model, threshold: float, radius: float):
    """One tile: linked weight of each vector and the root of its links within the tile."""
    def run(table: pa.Table) -> pa.Table:
        index, _ = model.value
        side = table.column("side").to_numpy()
        c, size = table.column("c").to_numpy(), table.column("size").to_numpy()
        x = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(len(c), -1)
        q, y = np.flatnonzero(side > 0), np.flatnonzero(side == 0)
        at = table.column("list")[0].as_py()
        links_q, links_y = [], []
        if len(q) and len(y):
            if at >= 0:
                code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(c), -1)[y]
                reach = (radius + table.column("error").to_numpy()[y] + 1e-6) ** 2
            for i in range(0, len(q), 512):
                own = q[i:i + 512]
                near = (side[own] == 2)[:, None] | (c[own][:, None] < c[y])  # within a list, each pair once
                if at >= 0:
                    near &= index.lookup(x[own], at, code) <= reach
                a, z = np.nonzero(near)
                ok = np.concatenate([np.einsum("ij,ij->i", x[own[a[k:k + 65536]]], x[y[z[k:k + 65536]]])
                                     for k in range(0, len(a), 65536)] or [np.empty(0)]) >= threshold
                links_q.append(own[a[ok]])
                links_y.append(y[z[ok]])
        a = np.concatenate(links_q) if links_q else np.empty(0, np.int64)
        z = np.concatenate(links_y) if links_y else a
        weight, root = np.zeros(len(c), np.int64), c.copy()
        np.add.at(weight, a, size[z])
        np.add.at(weight, z, size[a])
        while len(a):  # least id over links until it settles
            low, before = np.minimum(root[a], root[z]), root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, z, low)
            if (root == before).all():
                break
        some = weight > 0
        return pa.table({"c": pa.array(c[some]), "weight": pa.array(weight[some]), "root": pa.array(root[some])})

    return run


def vector_components(vectors: DataFrame, *, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                      label_col: str = "label", sample: int = 16_384, max_lists: int = 1024) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    v = F.col("v")
    good = (F.col("label").isNotNull() & v.isNotNull() & (F.size("v") > 0)
            & ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists("v", lambda e: e != 0))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    classes = save(rows.where("good").groupBy("label", "v")
                   .agg(F.min("id").alias("least"), F.count("*").alias("size"))
                   .withColumn("c", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vector-classes")
    dims = classes.groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(1).collect()
    alone = rows.where("not good").select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                                          F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not dims:
        return alone
    main, n = dims[0]["dim"], dims[0]["count"]
    few = (classes.where(F.col("dim") == main).orderBy(F.xxhash64("v", "label")).limit(sample)
           .select("v").toArrow().column("v").combine_chunks())
    lists = int(min(max_lists, max(1, 2 ** round(math.log2(math.sqrt(n))))))
    index = Index(_units(few, main), lists)
    model = spark.sparkContext.broadcast((index, main))
    radius = math.sqrt(2 - 2 * threshold)
    posted = save(classes.select("c", "label", "size", "dim", "v").mapInArrow(_post(model, radius), _POSTED), "postings")
    counts = posted.groupBy("label", "list").agg(F.count_if(F.col("side") == 0).alias("ys"), F.count_if(F.col("side") > 0).alias("qs"))
    cells = counts.where("ys > 0 and qs > 0").select(
        "label", "list", F.ceil(F.col("ys") / _TILE).cast("int").alias("ny"), F.ceil(F.col("qs") / _TILE).cast("int").alias("nq"))
    # the rows of a side go to one of its stripes and to every stripe of the other side
    met = posted.join(cells, ["label", "list"])
    stripe = F.pmod(F.xxhash64("c"), F.when(F.col("side") == 0, F.col("ny")).otherwise(F.col("nq"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("nq")).otherwise(F.col("ny")) - 1))
    tiles = met.withColumn("own", stripe).withColumn("other", others).select(
        "label", "list", F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")).alias("ty"),
        F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")).alias("tq"),
        "side", "c", "size", "vector", "code", "error")
    found = save(tiles.groupBy("label", "list", "ty", "tq").applyInArrow(_tile(model, threshold, radius), _FOUND), "vector-links")
    weight = found.groupBy("c").agg(F.sum("weight").alias("weight"))
    roots = components(found.where("c <> root").select(F.col("c").alias("a"), F.col("root").alias("b")))
    own = (classes.select("c", "label", "v", "least", "size").join(weight, "c", "left")
           .join(roots.select(F.col("node").alias("c"), "root"), "c", "left")
           .withColumn("root", F.coalesce("root", "c")))
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    own = own.join(least, "root").select(
        "label", "v", "component_id", (F.coalesce("weight", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    out = rows.where("good").join(own, ["label", "v"]).select(
        F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    return out.unionByName(alone)
