"""Minted, burned and supply per token."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (DEFAULT_RESOLVED_DECIMALS, DEFAULT_STATIC_DECIMALS, PRESET_DECIMALS,
                         STATIC_DECIMALS)
from ..functions.keys import is_valid_key
from ..functions.numeric import lookup, scale_down, scale_down_exact, valid_decimals
from .bound import bound_query
from .common import restrict

RAW = "decimal(38,0)"


def minted_by_token(mints: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """(mint, minted_raw): SUM(amount) GROUP BY mint, exact."""
    agg = (mints.where(is_valid_key("mint")).groupBy("mint")
           .agg(F.sum("amount").cast(RAW).alias("minted_raw")))
    return restrict(agg, tokens)


def burned_by_token(burns: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """(mint, burned_raw): SUM(amount) GROUP BY mint, exact."""
    agg = (burns.where(is_valid_key("mint")).groupBy("mint")
           .agg(F.sum("amount").cast(RAW).alias("burned_raw")))
    return restrict(agg, tokens)


def resolved_decimals(tokens: DataFrame, decimals: DataFrame | None) -> DataFrame:
    """The decimals map of a run: the token frame (all its columns kept) plus
    ``decimals`` = preset (SOL 9, USDC 6, USDT 6), else the resolved value,
    else 6.  A value outside 0..255 is unresolved; of several the largest counts."""
    base = tokens
    if decimals is not None:
        # one value per key even if the lookup repeats a (normalised) key
        per_key = decimals.groupBy("mint").agg(F.max(valid_decimals("decimals")).alias("_d"))
        base = base.join(per_key, "mint", "left")
        resolved = F.col("_d")
    else:
        resolved = F.lit(None)
    return base.select(*tokens.columns,
                       F.coalesce(lookup(F.col("mint"), PRESET_DECIMALS), resolved,
                                  F.lit(DEFAULT_RESOLVED_DECIMALS)).cast("int").alias("decimals"))


def supply_columns(minted, burned, decimals):
    """max(0, (minted - burned) / 10**d) rounded once."""
    diff = F.coalesce(minted, F.lit(0)).cast(RAW) - F.coalesce(burned, F.lit(0)).cast(RAW)
    return F.greatest(F.lit(0.0), scale_down_exact(diff, decimals))


def token_supply(tokens: DataFrame | None, mints: DataFrame, burns: DataFrame,
                 decimals: DataFrame | None = None) -> DataFrame:
    """(mint, decimals, minted_raw, burned_raw, supply).

    ``tokens=None`` means every minted token: the token set is then the key
    set of the minted aggregate itself (one aggregate of ``mints``, no join).
    With a decimals frame the run's map applies (default 6); without one the
    static table applies (SOL/USDC/USDT/USDH, else 9)."""
    if tokens is None:
        base = minted_by_token(mints)
    else:
        base = tokens.select("mint").join(minted_by_token(mints), "mint", "left")
    if decimals is not None:
        dec = resolved_decimals(base, decimals)
    else:
        dec = base.select("*", lookup(F.col("mint"), STATIC_DECIMALS, DEFAULT_STATIC_DECIMALS)
                          .cast("int").alias("decimals"))
    out = dec.join(burned_by_token(burns), "mint", "left")
    return out.select(
        "mint", "decimals",
        F.coalesce("minted_raw", F.lit(0).cast(RAW)).alias("minted_raw"),
        F.coalesce("burned_raw", F.lit(0).cast(RAW)).alias("burned_raw"),
        supply_columns(F.col("minted_raw"), F.col("burned_raw"), F.col("decimals")).alias("supply"))


def burned_normalized(tokens: DataFrame, burns: DataFrame, decimals: DataFrame | None) -> DataFrame:
    """(mint, burned): burned / 10**d with the run's decimals map, 0 if none."""
    dec = resolved_decimals(tokens.select("mint"), decimals)
    out = dec.join(burned_by_token(burns), "mint", "left")
    return out.select("mint", scale_down_exact(F.coalesce("burned_raw", F.lit(0)), "decimals")
                      .alias("burned"))


def initial_minted_normalized(mints: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """(mint, minted_raw, initial_minted_normalized): minted divided by the
    static decimals table (9 unless SOL/USDC/USDT/USDH), float first."""
    m = minted_by_token(mints, tokens)
    d = lookup(F.col("mint"), STATIC_DECIMALS, DEFAULT_STATIC_DECIMALS)
    return m.select("mint", "minted_raw",
                    scale_down("minted_raw", d).alias("initial_minted_normalized"))


TOKEN_SUPPLY_POINT_SQL = """
SELECT :token AS mint,
       greatest(CAST(0 AS DECIMAL(38,0)),
                CAST((SELECT coalesce(sum(amount), 0) FROM {mints} WHERE mint = :token) AS DECIMAL(38,0))
              - CAST((SELECT coalesce(sum(amount), 0) FROM {burns} WHERE mint = :token) AS DECIMAL(38,0)))
         AS supply_raw
"""


def token_supply_point(spark: SparkSession, mints: DataFrame, burns: DataFrame,
                       token: str) -> DataFrame:
    """max(0, minted - burned) in raw units for one token, as a bound
    parameterised query (the point filter reaches each scan)."""
    return bound_query(spark, TOKEN_SUPPLY_POINT_SQL, {"token": token}, {"mints": mints, "burns": burns})


def circulating_supply(supply: DataFrame, reserves: DataFrame) -> DataFrame:
    """(mint, supply, reserves, circulating_supply): max(0, supply - reserves)."""
    out = supply.select("mint", "supply").join(reserves.select("mint", "reserves"), "mint", "left")
    r = F.coalesce("reserves", F.lit(0.0))
    return out.select("mint", "supply", r.alias("reserves"),
                      F.greatest(F.lit(0.0), F.col("supply") - r).alias("circulating_supply"))
