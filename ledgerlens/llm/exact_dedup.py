"""Exact duplicates by distributed MSD radix partitioning (operator 10).

Texts are split by successive digits of their bytes, the most significant
first.  A digit is a run of bytes whose width grows from level to level
(64, 256, 1024 ...), so texts of any length need few levels.  At each level the
documents of one group are dealt by (group, digit, whether the text ends here):

* a part of one document is unique and leaves;
* a part whose texts end here holds equal texts: every byte was compared;
* any other part becomes a group of the next level.

No digest decides equality.  Documents leave as soon as they are alone, so the
levels after the first carry only texts that share a prefix.  Counts come from a
map-side combined aggregate, and documents meet their part's count in an
equi-join, which Spark can split when one part holds a large share of the rows (a
merge join at every size, so that the plan does not change as the data grow);
nothing gathers the documents of a part in one task.

Defined cases: a null text is an empty text; a null id orders before any other;
of rows equal in id and text just one is kept; other columns are carried only
when asked for; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .storage import remove_table, save
from .text import ascii_lower, whole


def exact_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  carry: Sequence[str] = (), digit: int = 64, growth: int = 4) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are compared after lower-casing A-Z.  ``carry`` names further input
    columns to return, as fields of a struct column ``row``.
    """
    row = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    norm = ascii_lower(whole(F.col(text_col)))
    state = docs.select(F.col(id_col).alias("id"), row.alias("row"), F.lit(0).cast("long").alias("gid"),
                        F.unhex(F.sha2(norm, 256)).alias("sha"), F.encode(norm, "UTF-8").alias("rest"))
    done, level, used = None, 0, None
    while True:
        head = F.substring("rest", 1, digit)
        dealt = (state.withColumn("head", head)
                 .withColumn("ends", F.length("rest") <= digit))
        parts = save(dealt.groupBy("gid", "head", "ends")
                     .agg(F.count("*").alias("n"), F.max("id").alias("last"))
                     .where("n > 1")
                     .withColumn("part", F.monotonically_increasing_id()), f"radix-parts{level}")
        met = dealt.join(parts.hint("merge"), ["gid", "head", "ends"], "left")
        going = F.col("part").isNotNull() & ~F.col("ends")
        step = save(met.select(
            "id", "row", "sha", "part", F.col("n").alias("size"), "last", going.alias("going"),
            F.when(going, F.expr(f"substring(rest, {digit + 1})")).alias("rest"),
            F.monotonically_increasing_id().alias("rid")), f"radix{level}")
        if used is not None:
            remove_table(used)
        remove_table(parts)
        used = save(step.where("going").select("id", "row", F.col("part").alias("gid"), "sha", "rest"),
                    f"radix-next{level}")
        left = step.where("not going").select("id", "row", "sha", "part", "size", "last", "rid",
                                              F.lit(level).alias("level"))
        done = left if done is None else done.unionByName(left)
        if used.isEmpty():
            break
        state, digit, level = used, digit * growth, level + 1
    # Of the rows equal in text and id with the largest id, the one with the largest row number stays.
    first = (done.where(F.col("part").isNotNull() & F.col("id").eqNullSafe(F.col("last")))
             .groupBy("level", "part").agg(F.max("rid").alias("rid"), F.lit(True).alias("first")))
    out = done.join(first, ["level", "part", "rid"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("part").isNull(), F.col("id")).otherwise(F.col("last")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("part").isNull() | F.coalesce("first", F.lit(False))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *([F.col("row")] if carry else []))


def drop_copies(docs: DataFrame, **kwargs) -> DataFrame:
    """The documents that stay, with their own columns."""
    kept = exact_classes(docs, carry=docs.columns, **kwargs).where("kept")
    return kept.select("row.*")
