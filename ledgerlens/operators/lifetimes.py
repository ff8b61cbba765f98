"""First-seen dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import is_valid_key
from .bound import bound_query
from .common import restrict


def first_mints(mints: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """(mint, first_mint): MIN(block_time) GROUP BY mint; null minima dropped."""
    agg = (mints.where(is_valid_key("mint")).groupBy("mint")
           .agg(F.min("block_time").alias("first_mint"))
           .where(F.col("first_mint").isNotNull()))
    return restrict(agg, tokens)


def swap_sides(swaps: DataFrame) -> DataFrame:
    """(mint, block_time) for the base side and the quote side of each swap:
    one scan and a generator instead of a UNION ALL of two scans."""
    return swaps.select(F.explode(F.array("base_coin", "quote_coin")).alias("mint"), "block_time")


def first_swaps(swaps: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """(mint, first_swap): earliest swap on either side; null minima dropped."""
    agg = (swap_sides(swaps).where(is_valid_key("mint")).groupBy("mint")
           .agg(F.min("block_time").alias("first_swap"))
           .where(F.col("first_swap").isNotNull()))
    return restrict(agg, tokens)


def first_tx_dates(tokens: DataFrame | None, mints: DataFrame, swaps: DataFrame) -> DataFrame:
    """(mint, first_mint, first_swap, first_tx_date) for every token; the
    date is the null-skipping minimum of the two (null when neither).
    ``tokens=None`` means every minted token, taken from the same aggregate
    of ``mints`` that gives the first mint."""
    per_mint = (mints.where(is_valid_key("mint")).groupBy("mint")
                .agg(F.min("block_time").alias("first_mint")))
    if tokens is None:
        base = per_mint
    else:
        base = tokens.select("mint").join(per_mint, "mint", "left")
    out = base.join(first_swaps(swaps), "mint", "left")
    return out.select("mint", "first_mint", "first_swap",
                      F.least("first_mint", "first_swap").alias("first_tx_date"))


FIRST_TX_POINT_SQL = """
SELECT :token AS mint,
       least((SELECT min(block_time) FROM {mints} WHERE mint = :token),
             (SELECT min(block_time) FROM {swaps}
               WHERE base_coin = :token OR quote_coin = :token)) AS first_tx_date
"""


def first_tx_point(spark: SparkSession, mints: DataFrame, swaps: DataFrame, token: str) -> DataFrame:
    """First transaction date of one token (null when it has none)."""
    return bound_query(spark, FIRST_TX_POINT_SQL, {"token": token}, {"mints": mints, "swaps": swaps})
