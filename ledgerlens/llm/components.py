"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import PART_ROWS, release, remove_table, save


def _stars(edges: DataFrame) -> bool:
    """Whether every higher end u has one edge and no lower end v has a lower end itself."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below"))))
    ends = ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return not ends.agg(F.max(F.col("above") + F.when(F.col("above") > 0, F.col("below")).otherwise(0)) > 1).first()[0]


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node reachable.

    Each round sends every edge's lower end to the neighbours of its higher end and
    hangs it there (small star after large star), so paths shorten by half or more;
    a node with very many neighbours is only ever combined, never collected.  Rounds end
    when stars alone are left.  No round has more edges than the first.
    """
    now = save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u <> v").distinct(), "edges")
    most = now.count()

    def dealt(edges: DataFrame) -> DataFrame:
        return edges.coalesce(1) if 2 * most <= PART_ROWS else edges  # so few meet in one task without a shuffle

    now = dealt(now)
    for _ in range(rounds):
        if _stars(now):
            break
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: neighbours above a node are linked to the least of its neighbourhood
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = dealt(save(large, "large-star", most_rows=most))
        # small star: a node's lower neighbours and the node are linked to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        new = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        new = dealt(save(new, "small-star", most_rows=most))
        remove_table(large)
        remove_table(now)
        now = new
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    out = save(now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "roots", most_rows=2 * most)
    remove_table(now)
    release(edges.sparkSession)  # plans and shuffle files of the rounds
    return out
