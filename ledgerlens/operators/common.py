"""Small shared pieces of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ANCHORS, SOL, SOL_PRICE_USD, STABLECOINS


def keys_of(tokens: DataFrame, name: str = "mint") -> DataFrame:
    """The token set as a one-column frame named ``name``."""
    return tokens.select(F.col("mint").alias(name))


def restrict(df: DataFrame, tokens: DataFrame | None, key: str = "mint") -> DataFrame:
    """Keep rows of ``df`` whose ``key`` is in the token set.

    An inner join on the token set's unique key rather than a left-semi
    join: Catalyst pushes a semi join below an aggregate or window over the
    same key, which would shuffle every raw event row (and a hot key's third
    of them into one task) instead of the per-key partial results."""
    if tokens is None:
        return df
    return df.join(keys_of(tokens, key), key, "inner")


def is_anchor(c: Column) -> Column:
    return c.isin(*ANCHORS)


def is_stable(c: Column) -> Column:
    return c.isin(*STABLECOINS)


def is_sol(c: Column) -> Column:
    return c == F.lit(SOL)


def usd_per_unit(coin: Column, sol_price: float) -> Column:
    """SOL is worth the anchor price, anything else 1.0 (reference parity)."""
    return F.when(is_sol(coin), F.lit(float(sol_price))).otherwise(F.lit(1.0))


def effective_sol_price(sol_price: float | None) -> float:
    """``set_sol_price`` is skipped when the price is falsy."""
    return float(sol_price) if sol_price else SOL_PRICE_USD
