"""Market capitalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def market_caps(supplies: DataFrame, prices: DataFrame, supply_col: str = "supply") -> DataFrame:
    """(mint, supply, price_usd, market_cap_usd) for every supplied token:
    supply x price, a token without a price is worth 0."""
    out = supplies.select("mint", supply_col).join(prices.select("mint", "price_usd"), "mint", "left")
    price = F.coalesce("price_usd", F.lit(0.0))
    return out.select("mint", F.col(supply_col).alias("supply"), price.alias("price_usd"),
                      (F.col(supply_col) * price).alias("market_cap_usd"))
