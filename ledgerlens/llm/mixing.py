"""Mixing sources to target weights by Pareto order sampling (operator 2).

1. *Targets.*  The mix shall hold ``total`` times all words, shared among the
   sources by weight; a target stops at ``max_copies`` times its source and the
   excess is shared again among the others (water filling, solved in closed form
   over the sources sorted by the level at which they fill up).
2. *Whole copies.*  A source that has to be repeated ``f`` times gives
   ``floor(f)`` certain copies of each document.
3. *The rest* is a sample of fixed size in words with unequal inclusion
   probabilities p = min(1, c * length ** -exponent): short documents are
   somewhat likelier, so that a few very long ones don't make up the sample.  c
   makes the expected words equal to the rest, solved over length classes.
4. *Pareto ranks.*  A document gets u from a hash of its id and text and the
   rank q = (u / (1 - u)) / (p / (1 - p)); the lowest ranks are taken until the
   words are used up, then further documents that still fit (``fill`` passes), at
   last one document that overshoots if that comes nearer.

A source may hold most rows, so ranks are never sorted per source: ranks fall
into ``bins`` and only the words per (source, bin) are summed in order; then the
rows of the one bin in which the words run out are sorted.  Sources thus cost
``bins`` rows each, whatever their size.  The result is a cut per source, which
each row compares with its own rank.

Defined cases: a null text has no words; a null source is a source of its own,
ordered last; rows equal in id and text share one fate; no rows give no rows.
The same input gives the same mix on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .storage import release, save
from .text import n_words

WEIGHTS = (5.0, 2.0, 1.0)
_LEAST = -(2 ** 63)


def source_targets(sizes: DataFrame, weights: Sequence[float], total: float, max_copies: float) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    full = F.col("source_size") * float(max_copies)
    by_level = W.orderBy("level", F.col("source").asc_nulls_last())
    before, after = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(0, W.unboundedFollowing)
    everyone = W.partitionBy(F.lit(0))
    per = (per.withColumn("weight", weight).withColumn("full", full).withColumn("level", full / F.col("weight"))
           .withColumn("all", F.sum("source_size").over(everyone) * float(total))
           .withColumn("share", (F.col("all") - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
                       / F.sum("weight").over(after))
           # a source is full when the level with all lower ones full is not below its own
           .withColumn("is_full", F.col("share") >= F.col("level"))
           .withColumn("common", F.max(F.when(~F.col("is_full"), F.col("share"))).over(everyone)))
    target = F.when(F.col("is_full"), F.col("full")).otherwise(F.least("full", F.col("common") * F.col("weight")))
    return per.select("source", "source_size", target.cast("double").alias("target"))


def _class(size: Column) -> Column:
    return F.floor(4 * F.log2(F.greatest(size, F.lit(1)))).cast("int")


def _inclusion(sizes: DataFrame, targets: DataFrame, exponent: float) -> DataFrame:
    """(source, class, p) so that the sum of p * size over a source is its rest."""
    spread = F.pow(F.lit(2.0), -exponent * F.col("class") / 4)
    per = (sizes.groupBy("source", _class(F.col("size")).alias("class")).agg(F.sum("size").alias("words"))
           .withColumn("m", spread))
    t = targets.select(F.col("source").alias("s"), "rest")
    per = per.join(t, per.source.eqNullSafe(t.s)).drop("s")
    order = W.partitionBy("source").orderBy("class")  # the likeliest classes first
    left = F.col("rest") - F.coalesce(F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_ = F.sum(F.col("words") * F.col("m")).over(order.rowsBetween(0, W.unboundedFollowing))
    per = (per.withColumn("c", F.when(open_ > 0, left / open_).otherwise(0.0))
           .withColumn("sure", F.col("c") * F.col("m") >= 1)
           .withColumn("c", F.max(F.when(~F.col("sure"), F.col("c"))).over(W.partitionBy("source"))))
    p = F.when(F.col("sure"), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("c") * F.col("m"))))
    return per.select("source", "class", p.alias("p"))


def _bin(bins: int) -> Column:
    return F.least(F.floor(F.col("rank") * bins), F.lit(bins - 1))


def _with(rows: DataFrame, state: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns that ``state`` has for their source."""
    s = state.withColumnRenamed("source", "s_source")
    return rows.join(s, rows.source.eqNullSafe(s.s_source), how).drop("s_source")


def _edges(left: DataFrame, state: DataFrame, bins: int) -> DataFrame:
    """``state`` with, by source of ``left``, all its words and the bin in which they run beyond ``quota``.

    left: (source, size, rank, quota); new columns: everything, edge (bin, used: the words before it).
    """
    per = left.groupBy("source", _bin(bins).alias("bin")).agg(F.sum("size").alias("words"), F.max("quota").alias("quota"))
    per = per.withColumn("upto", F.sum("words").over(W.partitionBy("source").orderBy("bin")))
    edge = F.when(F.col("upto") > F.col("quota"), F.struct("bin", (F.col("upto") - F.col("words")).alias("used")))
    ends = per.groupBy("source").agg(F.sum("words").alias("everything"), F.min(edge).alias("edge"))
    return _with(state, ends, "left")


def _cuts(left: DataFrame, state: DataFrame, bins: int, room: Column) -> DataFrame:
    """The next state: a cut more per source, the longest run of lowest ranks whose words do not exceed ``quota``,
    and the words that then lack; null where a source has no rows left.

    left: (source, size, rank, tie, quota, edge); state: that of :func:`_edges`.
    """
    inside = (left.where(_bin(bins) == F.col("edge.bin"))
              .withColumn("upto", F.col("edge.used") + F.sum("size").over(
                  W.partitionBy("source").orderBy("rank", "tie").rowsBetween(W.unboundedPreceding, 0)))
              .where("upto <= quota").groupBy("source")
              .agg(F.max(F.struct("rank", "tie")).alias("inner"), F.max("upto").alias("words")))
    none = F.lit(_LEAST).alias("tie")
    cut = (F.when(F.col("edge").isNull(), F.struct(F.lit(2.0).alias("rank"), none))
           .otherwise(F.coalesce("inner", F.struct((F.col("edge.bin") / bins).alias("rank"), none))))
    words = F.when(F.col("edge").isNull(), F.col("everything")).otherwise(F.coalesce("words", "edge.used"))
    mark = F.array(F.struct(room.alias("room"), cut.alias("cut")))
    return _with(state, inside, "left").select(
        "source", F.when(F.col("everything").isNull(), F.col("marks")).otherwise(F.concat("marks", mark)).alias("marks"),
        (F.col("quota") - words).alias("quota"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, total: float = 1.5, max_copies: float = 2.0,
        exponent: float = 0.5, bins: int = 4096, fill: int = 3, seed: int = 17,
        carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken (words).

    ``carry`` returns further input columns in a struct column ``row``.
    """
    row = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    sized = save(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("tie"), row.alias("row")), "mix-sized")
    narrow = sized.select("source", "size", "tie")
    targets = source_targets(narrow, weights, total, max_copies)
    whole_copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = save(targets.withColumn("base", whole_copies.cast("long"))
                   .withColumn("rest", F.col("target") - F.col("base") * F.col("source_size")), "mix-targets")
    odds = save(_inclusion(narrow, targets, exponent), "mix-odds")

    def ranked(rows: DataFrame) -> DataFrame:
        o = odds.select(F.col("source").alias("o_source"), F.col("class").alias("o_class"), "p")
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), "tie"), 11) + F.lit(0.5)) / float(2 ** 53)
        q = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
        # q / (1 + q) has the same order and lies between 0 and 1
        rank = F.when(F.col("p") >= 1, 0.0).when(F.col("p") <= 0, 1.0).otherwise(q / (1 + q))
        return (rows.join(o, rows.source.eqNullSafe(o.o_source) & (_class(F.col("size")) == o.o_class), "left")
                .withColumn("rank", rank).drop("o_source", "o_class", "p"))

    rows = save(ranked(narrow), "mix-ranks")
    release(docs.sparkSession)
    # what is known of a source: which documents are taken (of at most ``room`` words, ranking up to ``cut``), and the
    # words it lacks; one table after each pass, so that a plan does not hold those of the passes before
    marks = "array<struct<room:double,cut:struct<rank:double,tie:bigint>>>"
    state = targets.select("source", F.array().cast(marks).alias("marks"), F.col("rest").alias("quota"))
    for k in range(1 + fill):
        room = F.lit(float("inf")) if k == 0 else F.col("quota")
        state = save(_edges(_left(rows, state, k), state, bins), f"mix-edge{k}")
        state = save(_cuts(_left(rows, state, k), state, bins, room), f"mix-cut{k}")
    # what then still lacks: the one document that comes nearest from above, if it is nearer than none
    last = (_with(rows, state).where(~_taken())
            .where((F.col("size") > F.col("quota")) & (F.col("size") < 2 * F.col("quota")))
            .groupBy("source").agg(F.min(F.struct("size", "tie")).alias("last"))
            .select("source", F.col("last.tie").alias("extra")))
    fate = save(_with(_with(targets.select("source", "source_size", "target", "base"), state.drop("quota"), "left"), last, "left"),
                "mix-fate")
    out = _with(ranked(sized), fate, "left")
    copies = (F.col("base") + F.when(_taken() | F.coalesce(F.col("tie") == F.col("extra"), F.lit(False)), 1).otherwise(0)).cast("long")
    return out.withColumn("copies", F.least(copies, F.lit(int(max_copies)).cast("long"))).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), *([F.col("row")] if carry else []))


def _taken() -> Column:
    """Whether a row's rank is inside one of its source's marks."""
    return F.exists("marks", lambda m: (F.col("size") <= m["room"])
                    & (F.struct("rank", "tie") <= m["cut"]))


def _left(rows: DataFrame, state: DataFrame, k: int) -> DataFrame:
    """Rows with the state of their source; after the first pass those not taken so far that fit into what it lacks."""
    left = _with(rows, state)
    return left if k == 0 else left.where(~_taken()).where(F.col("size") <= F.col("quota"))


def mixed_documents(docs: DataFrame, **kwargs) -> DataFrame:
    """The documents of the mix, a row per copy, with their own columns."""
    return (mix(docs, carry=docs.columns, **kwargs)
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
            .select("row.*"))
