"""Pools: latest state, candidacy, balances, liquidity, best pool, reserves
(P2, P3, H1, A8, J7, P5-P8, J8, A10, A11, M7, M8, M15).

A pool is the triple (canonical source, base coin, quote coin).  Whether a
pool is a candidate depends on its two coins only, so the latest state is
aggregated over every swap that has an anchor (SOL, USDC, USDT) on one side
- a literal filter the Parquet reader evaluates - and the token set is
joined to the much smaller per-pool result afterwards:

    swaps --anchor filter--> max(struct(time, base, quote)) per pool  [partial agg]
          --HAVING both > 0--> left join token map on the coin that is no anchor
          (membership, decimals) --> candidacy --> one row per token side
          --> per token: best pool and reserves (one partial + final aggregate)

No OR-join, no nested-loop join; hot pools and hot tokens are reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ANCHORS, DEFAULT_POOL_DECIMALS, SOL_POOL_DECIMALS
from ..functions.numeric import scale_down, scale_down_exact
from ..functions.sources import canonical_source, is_bonding, pool_class
from .common import effective_sol_price, is_anchor, is_sol, is_stable, keys_of, usd_per_unit

POOL_KEYS = ("canonical_source", "base_coin", "quote_coin")


def anchor_swaps(swaps: DataFrame) -> DataFrame:
    """Swaps with an anchor on at least one side (necessary for candidacy)."""
    return swaps.where(is_anchor(F.col("base_coin")) | is_anchor(F.col("quote_coin")))


def latest_pool_state(swaps: DataFrame) -> DataFrame:
    """(canonical_source, base_coin, quote_coin, last_block_time,
    last_base_balance, last_quote_balance) over anchor-paired swaps.

    Both balances come from one row: the latest by (block_time, base balance,
    quote balance), a total order, so ties are settled the same way on every
    run.  ``max(struct)`` aggregates partially before the shuffle.  It does so
    sorted, so a hash of the key leads the grouping: rows are then ordered by
    one number, where sources and anchors, the same in most rows, would make
    every comparison read whole keys."""
    latest = F.max(F.struct(F.col("block_time").alias("t"),
                            F.col("base_pool_balance_after").alias("b"),
                            F.col("quote_pool_balance_after").alias("q"))).alias("s")
    return (anchor_swaps(swaps)
            .where(F.col("block_time").isNotNull()
                   & F.col("base_pool_balance_after").isNotNull()
                   & F.col("quote_pool_balance_after").isNotNull())
            .select(canonical_source("source").alias("canonical_source"), "base_coin",
                    "quote_coin", "block_time", "base_pool_balance_after",
                    "quote_pool_balance_after")
            .groupBy(F.xxhash64(*POOL_KEYS).alias("_pool"), *POOL_KEYS).agg(latest)
            .select(*POOL_KEYS, F.col("s.t").alias("last_block_time"),
                    F.col("s.b").alias("last_base_balance"),
                    F.col("s.q").alias("last_quote_balance")))


def live_pools(swaps: DataFrame) -> DataFrame:
    """HAVING last_base_balance > 0 AND last_quote_balance > 0: a pool whose
    latest state is empty disappears (no fallback to an older state)."""
    return latest_pool_state(swaps).where((F.col("last_base_balance") > 0)
                                          & (F.col("last_quote_balance") > 0))


def _default_pool_decimals(coin):
    return F.when(is_sol(coin), F.lit(SOL_POOL_DECIMALS)).otherwise(F.lit(DEFAULT_POOL_DECIMALS))


def candidate_pool_states(swaps: DataFrame, decimals_map: DataFrame) -> DataFrame:
    """Live pools that are candidates for the token set, one row per pool,
    with each side's membership and decimals.

    ``decimals_map`` is the run's token set with its decimals (mint,
    decimals), one row per token.  Every live pool has an anchor on a side,
    so a join on either coin would gather most pools in three keys.  The map is
    therefore joined on the coin that is no anchor (null in a pool of two
    anchors, of which there are a handful); the anchors' own rows, three as
    keys are unique, come from one pass over the same map and are broadcast.  A pool is a candidate when some
    side is a token whose other side is an anchor.  A side that is not a token
    takes 9 decimals for SOL and 6 otherwise."""
    dm = decimals_map.select("mint", "decimals")
    base, quote = F.col("base_coin"), F.col("quote_coin")
    # each the maximum of one value or none; a filter on the three keys would go below the map's own aggregate and read its input anew
    row = dm.agg(*[F.max(F.when(F.col("mint") == a, F.col("decimals"))).alias(f"_d{i}") for i, a in enumerate(ANCHORS)])
    anchors = F.broadcast(row.select(F.inline(F.array(*[F.struct(F.lit(a).alias("mint"), F.col(f"_d{i}").alias("decimals"))
                                                        for i, a in enumerate(ANCHORS)]))))

    def anchor_rows(side: str) -> DataFrame:
        return anchors.select(F.col("mint").alias(f"{side}_coin"), F.col("decimals").alias(f"_{side}_d"))

    others = dm.select(F.col("mint").alias("_other"), F.col("decimals").alias("_other_d"))
    pools = (live_pools(swaps)
             .withColumn("_other", F.when(~is_anchor(base), base).when(~is_anchor(quote), quote))
             .join(others, "_other", "left")
             .join(anchor_rows("base"), "base_coin", "left")
             .join(anchor_rows("quote"), "quote_coin", "left")
             .withColumn("_bd", F.when(is_anchor(base), F.col("_base_d")).otherwise(F.col("_other_d")))
             .withColumn("_qd", F.when(is_anchor(quote), F.col("_quote_d")).otherwise(F.col("_other_d"))))
    base_in, quote_in = F.col("_bd").isNotNull(), F.col("_qd").isNotNull()
    candidate = ((base_in & is_anchor(F.col("quote_coin")))
                 | (quote_in & is_anchor(F.col("base_coin"))))
    return pools.where(candidate).select(
        *POOL_KEYS, "last_block_time", "last_base_balance", "last_quote_balance",
        base_in.alias("base_is_token"), quote_in.alias("quote_is_token"),
        F.coalesce("_bd", _default_pool_decimals(F.col("base_coin"))).cast("int").alias("base_decimals"),
        F.coalesce("_qd", _default_pool_decimals(F.col("quote_coin"))).cast("int").alias("quote_decimals"))


def pool_sides(swaps: DataFrame, decimals_map: DataFrame, sol_price: float | None = None) -> DataFrame:
    """One row per (candidate pool, side coin in the token set): the pool is
    offered to each of its sides that is a token (base = quote gives two
    rows), with normalised balances, liquidity, class and the side's price."""
    price = effective_sol_price(sol_price)
    pools = candidate_pool_states(swaps, decimals_map)
    side = F.explode(F.array(
        F.when(F.col("base_is_token"),
               F.struct(F.col("base_coin").alias("mint"), F.lit(True).alias("token_is_base"),
                        F.col("base_decimals").alias("token_decimals"))),
        F.when(F.col("quote_is_token"),
               F.struct(F.col("quote_coin").alias("mint"), F.lit(False).alias("token_is_base"),
                        F.col("quote_decimals").alias("token_decimals"))))).alias("side")
    out = (pools.select("*", side).where(F.col("side").isNotNull())
           .select("side.mint", *POOL_KEYS, "side.token_is_base", "last_block_time",
                   "last_base_balance", "last_quote_balance", "side.token_decimals",
                   "base_decimals", "quote_decimals"))
    return valued_pools(out, price).select("*", pool_price(price).alias("price_usd"))


def valued_pools(pools: DataFrame, sol_price: float | None = None) -> DataFrame:
    """Candidate pools (or their sides) with normalised balances, liquidity and class."""
    out = pools.select(
        "*",
        scale_down("last_base_balance", "base_decimals").alias("base_balance_norm"),
        scale_down("last_quote_balance", "quote_decimals").alias("quote_balance_norm"))
    return out.select("*", pool_liquidity(sol_price).alias("liquidity_usd"),
                      is_bonding("canonical_source").alias("is_bonding"))


def pool_liquidity(sol_price: float | None = None):
    """USD liquidity of a pool from normalised balances: the first of base =
    SOL, quote = SOL, base stable, quote stable, valued and doubled; else 0."""
    p = F.lit(effective_sol_price(sol_price))
    b, q = F.col("base_balance_norm"), F.col("quote_balance_norm")
    base, quote = F.col("base_coin"), F.col("quote_coin")
    return (F.when(is_sol(base), b * p * F.lit(2.0))
            .when(is_sol(quote), q * p * F.lit(2.0))
            .when(is_stable(base), b * F.lit(2.0))
            .when(is_stable(quote), q * F.lit(2.0))
            .otherwise(F.lit(0.0)))


def pool_price(sol_price: float | None = None):
    """USD price of the side token ``mint`` from the pool's balances: the other
    side valued at the SOL price if SOL else 1.0, over the own side; 0 unless
    both balances are positive."""
    price = effective_sol_price(sol_price)
    b, q = F.col("base_balance_norm"), F.col("quote_balance_norm")
    own_is_base = F.col("mint") == F.col("base_coin")
    as_base = (q * usd_per_unit(F.col("quote_coin"), price)) / b
    as_quote = (b * usd_per_unit(F.col("base_coin"), price)) / q
    return (F.when((b > 0) & (q > 0), F.when(own_is_base, as_base).otherwise(as_quote))
            .otherwise(F.lit(0.0)))


def candidate_pools(swaps: DataFrame, decimals_map: DataFrame) -> DataFrame:
    """(canonical_source, base_coin, quote_coin, last_base_balance,
    last_quote_balance): the live pools offered to at least one token."""
    return candidate_pool_states(swaps, decimals_map).select(
        *POOL_KEYS, "last_base_balance", "last_quote_balance")


def best_pools(sides: DataFrame) -> DataFrame:
    """Top pool per token: any priority pool before any bonding-curve pool,
    then highest liquidity (zero allowed), then source, base, quote."""
    w = Window.partitionBy("mint").orderBy(
        F.col("is_bonding").asc(), F.col("liquidity_usd").desc(), F.col("canonical_source").asc(),
        F.col("base_coin").asc(), F.col("quote_coin").asc(), F.col("token_is_base").desc())
    return (sides.select("mint", F.col("canonical_source").alias("source"), "liquidity_usd",
                         "price_usd", "is_bonding", "base_coin", "quote_coin", "token_is_base",
                         F.row_number().over(w).alias("_rn"))
            .where(F.col("_rn") == 1)
            .select("mint", "source", "liquidity_usd", "price_usd"))


def best_pool_metrics(tokens: DataFrame, swaps: DataFrame, decimals_map: DataFrame,
                      sol_price: float | None = None, sides: DataFrame | None = None) -> DataFrame:
    """(mint, source, liquidity_usd, price_usd) for every token; '' / 0.0 /
    0.0 when it has no candidate pool."""
    if sides is None:
        sides = pool_sides(swaps, decimals_map, sol_price)
    best = best_pools(sides)
    out = keys_of(tokens).join(best, "mint", "left")
    return out.select("mint", F.coalesce("source", F.lit("")).alias("source"),
                      F.coalesce("liquidity_usd", F.lit(0.0)).alias("liquidity_usd"),
                      F.coalesce("price_usd", F.lit(0.0)).alias("price_usd"))


def _own_raw():
    return F.when(F.col("token_is_base"), F.col("last_base_balance")).otherwise(
        F.col("last_quote_balance"))


def reserves_by_token(sides: DataFrame) -> DataFrame:
    """(mint, reserves): the token's own-side balances summed exactly in raw
    units over its candidate pools, scaled once by its decimals."""
    agg = (sides.groupBy("mint")
           .agg(F.sum(_own_raw()).cast("decimal(38,0)").alias("_raw"),
                F.max("token_decimals").alias("_d")))
    return agg.select("mint", scale_down_exact("_raw", "_d").alias("reserves"))


def pool_summary_by_token(sides: DataFrame) -> DataFrame:
    """(mint, source, liquidity_usd, price_usd, reserves): best pool and
    reserves from one partial aggregate per token.  The best pool is the
    minimum of (is_bonding, -liquidity, source, base, quote, base side
    first), the order of ``best_pools``."""
    rank = F.struct(F.col("is_bonding").alias("k0"), (-F.col("liquidity_usd")).alias("k1"),
                    F.col("canonical_source").alias("k2"), F.col("base_coin").alias("k3"),
                    F.col("quote_coin").alias("k4"), (~F.col("token_is_base")).alias("k5"),
                    F.col("liquidity_usd").alias("liquidity_usd"), F.col("price_usd").alias("price_usd"))
    # grouped by the token alone (its decimals are one value per token), so
    # the result is hash partitioned like every other per-token input
    agg = (sides.groupBy("mint")
           .agg(F.min(rank).alias("_best"), F.sum(_own_raw()).cast("decimal(38,0)").alias("_raw"),
                F.max("token_decimals").alias("token_decimals")))
    return agg.select("mint", F.col("_best.k2").alias("source"),
                      F.col("_best.liquidity_usd").alias("liquidity_usd"),
                      F.col("_best.price_usd").alias("price_usd"),
                      scale_down_exact("_raw", "token_decimals").alias("reserves"))


def token_reserves(tokens: DataFrame, swaps: DataFrame, decimals_map: DataFrame,
                   sides: DataFrame | None = None) -> DataFrame:
    """(mint, reserves) for every token, 0.0 without candidate pools."""
    if sides is None:
        sides = pool_sides(swaps, decimals_map)
    out = keys_of(tokens).join(reserves_by_token(sides), "mint", "left")
    return out.select("mint", F.coalesce("reserves", F.lit(0.0)).alias("reserves"))


def pool_class_counts(swaps: DataFrame) -> DataFrame:
    """(pool_class, n_pools): live anchor pools per class."""
    pools = live_pools(swaps)
    return pools.groupBy(pool_class("canonical_source").alias("pool_class")).agg(F.count(F.lit(1)).alias("n_pools"))


def canonical_source_counts(swaps: DataFrame) -> DataFrame:
    """(canonical_source, n_swaps) over every swap."""
    return (swaps.groupBy(canonical_source("source").alias("canonical_source"))
            .agg(F.count(F.lit(1)).alias("n_swaps")))


__all__ = ["anchor_swaps", "latest_pool_state", "live_pools", "candidate_pool_states", "pool_sides", "valued_pools", "pool_liquidity",
           "pool_price", "candidate_pools", "best_pools", "best_pool_metrics",
           "reserves_by_token", "pool_summary_by_token", "token_reserves", "pool_class_counts", "canonical_source_counts",
           "POOL_KEYS"]
