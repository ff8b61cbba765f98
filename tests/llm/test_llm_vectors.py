"""Hard negatives and Lloyd's rounds against plain loops."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import exact
from ledgerlens.llm.centroids import lloyd
from ledgerlens.llm.hard_negatives import Lists, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def integers(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def last_null(x):
    return (x is None, x or 0)


def negatives(rows, positives=5, most=10, low=30, high=90):
    """rows: (id, vector, label)."""
    rows = [(i, integers(v, 256), lab) for i, v, lab in rows if lab is not None and usable(v)]
    out = []
    for k, (a, x, lab) in enumerate(rows):
        if a is None or a % 100:
            continue
        others = sorted(((-sum(p * q for p, q in zip(x, y)), last_null(i), i, other == lab)
                         for n, (i, y, other) in enumerate(rows) if n != k and len(y) == len(x)), key=lambda r: r[:2])
        for s, _, p, _ in [r for r in others if r[3]][:positives]:
            hard = [(i, -t) for t, _, i, alike in others if not alike and low * -s <= 100 * -t <= high * -s][:most]
            out += [(a, p, rank, i, -s, t) for rank, (i, t) in enumerate(hard, 1)]
    return out


def vectors(seed=0, n=260, dim=8):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((5, dim))
    rows = []
    for i in range(n):
        v = (base[rng.integers(5)] + rng.standard_normal(dim) * 0.6) * (1 if i % 40 else 0)
        rows.append((i * 5, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    odd = [(5000, None, 1), (5100, [], 1), (5200, [], 2), (5300, [1.0, None] + [0.0] * (dim - 2), 1), (5400, [float("nan")] * dim, 1),
           (5500, [float("-inf")] * dim, 1), (5600, [1.0, 2.0], 1), (5700, [2.0, 4.0], 2), (5800, [2.0, 1.0], 1),
           (None, rows[3][1], 1), (None, rows[3][1], 2), (6000, [0.5] * dim, None)]
    return rows + odd + rows[:60] + [(i, v, (lab + 1) % 3) for i, v, lab in rows[20:40]]


def ask(df, **kwargs):
    got = hard_negatives(df, F.col("vec_id") % 100 == 0, **kwargs).collect()
    return sorted((tuple(r) for r in got), key=lambda r: [last_null(x) for x in r])


@pytest.mark.parametrize("tile", [{}, {"block": 32, "group": 4}])
def test_hard_negatives(spark, tile):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as row", "2 as id", "3 as anchor", "'x' as v", "4 as dim")
    want = sorted(negatives(rows), key=lambda r: [last_null(x) for x in r])
    assert len(want) > 100 and ask(df, **tile) == want


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame(vectors(), SCHEMA)
    assert ask(df.limit(0)) == [] and ask(df.where("vec_id % 100 <> 0")) == [] and ask(df.where("label = 1")) == []
    empty = df.select("vec_id", "label", F.lit(None).cast("array<float>").alias("embedding"))
    assert ask(empty) == []


def test_threshold_stops_early_and_meets_ties():
    """The scan ends before the lists do, and rows whose score equals the last one's are still met."""
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (4000, 3))
    x[100:110] = [90, -90, 0]
    lists, ids = Lists(x), np.arange(4000)[::-1].copy()
    (rows, score), = lists.best(np.array([5, -5, 0]), np.ones(4000, bool), ids, 4, [(-10 ** 9, 10 ** 9)])
    assert ids[rows].tolist() == sorted(ids[100:110])[:4] and set(score) == {900}
    assert lists.met < 400
    lists.met = 0
    a, window = np.array([5, -5, 1]), (-100, 120)
    (rows, score), = lists.best(a, np.arange(4000) % 2 == 0, ids, 7, [window])
    all_ = x @ a
    want = sorted((-s, i) for s, i, n in zip(all_, ids, range(4000)) if n % 2 == 0 and window[0] <= s <= window[1])[:7]
    assert [(-s, i) for s, i in zip(score, ids[rows])] == want and lists.met <= 4000


def clustered(rows, k=16, rounds=3, dim=64, scale=64):
    """rows: (id, vector) -> (id, cluster, distance, cluster inertia, inertia, centroid)."""
    kept = [(i, integers(v, scale), v) for i, v in rows if usable(v) and len(v) == dim]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    centres = [x for _, x, _ in first[:k]]
    for step in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centres)) for _, x, _ in kept]
        if step < rounds:
            for n in range(len(centres)):
                own = [x for (_, x, _), (_, m) in zip(kept, near) if m == n]
                centres[n] = [sum(col) // len(own) for col in zip(*own)] if own else centres[n]
    per = {n: sum(d for d, m in near if m == n) for n in range(len(centres))}
    return [(i, m, d, per[m], sum(per.values()), centres[m]) for (i, _, _), (d, m) in zip(kept, near)]


@pytest.mark.parametrize("cut", [{}, {"shards": 3, "chunk": 7}, {"shards": 100, "chunk": 50}])
def test_lloyd(spark, cut):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((9, 6))
    rows = [(i, [float(np.float32(x)) for x in base[rng.integers(9)] + rng.standard_normal(6) * 0.2]) for i in range(220)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (500, None), (501, []), (502, [1.0] * 5), (503, [float("nan")] * 6),
             (504, [None] + [1.0] * 5), (505, [float("inf")] * 6), (None, [0.0] * 6), (506, [1e4, -1e4, 0.0, 3.0, -3.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = lloyd(df.selectExpr("*", "1 as id", "2 as chunk", "'n' as n", "3 as shard", "4 as v"), dim=6, k=16, **cut).collect()
    key = lambda r: [last_null(x) if not isinstance(x, list) else x for x in r]
    assert sorted((tuple(r) for r in got), key=key) == sorted(clustered(rows, dim=6), key=key)


def test_lloyd_of_few_vectors(spark):
    rows = [(i, [float(i), 1.0]) for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = lloyd(df, dim=2).collect()
    assert sorted(map(tuple, got)) == sorted(clustered(rows, dim=2)) and {r.distance for r in got} == {0}
    none = lloyd(df.limit(0), dim=2)
    assert none.count() == 0 and none.columns == lloyd(df, dim=2).columns
    assert lloyd(df.withColumn("embedding", F.lit(None).cast("array<float>")), dim=2).count() == 0


def test_exact_arithmetic():
    rng = np.random.default_rng(5)
    for top in (10, 2 ** 24, 2 ** 29):
        x, y = rng.integers(-top, top, (40, 5)), rng.integers(-top, top, (5, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(r, c)) for c in y.T] for r in x]
        assert exact.dot(x, y).tolist() == want
        assert exact.unpack(exact.pack(x), x.size).reshape(x.shape).tolist() == x.tolist()
    with pytest.raises(OverflowError):
        exact.dot(np.array([[2 ** 32]]), np.array([[2 ** 32]]))
    with pytest.raises(OverflowError):
        exact.floors(pa.array([[1e30]]), 64, 2 ** 27)
    x, at = exact.floors(pa.array([[-0.01, 0.5], [], [1.0]]), 64, 2 ** 27)
    assert x.tolist() == [-1, 32, 64] and at.tolist() == [0, 2, 2, 3]
