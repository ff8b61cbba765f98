"""Trade-based prices (U2, A9, M9; O2, P9, A12, P10, M10).

Two alternatives to the pool-balance price, kept as separate operators:
the latest trade against SOL, and the best of a token's 100 most recent
trades.  Both ignore decimals, as the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import RECENT_SWAPS_PER_TOKEN
from ..functions.keys import is_valid_key
from ..functions.numeric import ratio
from .bound import bound_query
from .common import effective_sol_price, is_sol, is_stable, keys_of, restrict

SWAP_VALUE_COLUMNS = ("base_coin", "quote_coin", "base_pool_balance_after",
                      "quote_pool_balance_after", "base_coin_amount", "quote_coin_amount")


def sol_trades(swaps: DataFrame) -> DataFrame:
    """(mint, block_time, price): token priced in SOL per trade.  A swap
    with SOL on one side yields the other side; SOL/SOL yields both rows.
    A zero own amount gives a null price (NULLIF)."""
    base, quote = F.col("base_coin"), F.col("quote_coin")
    legs = F.array(
        F.when(is_sol(quote), F.struct(base.alias("mint"),
                                       ratio("quote_coin_amount", "base_coin_amount").alias("price"))),
        F.when(is_sol(base), F.struct(quote.alias("mint"),
                                      ratio("base_coin_amount", "quote_coin_amount").alias("price"))))
    return (swaps.where(is_sol(base) | is_sol(quote))
            .select("block_time", F.explode(legs).alias("leg"))
            .where(F.col("leg").isNotNull())
            .select("leg.mint", "block_time", "leg.price"))


def latest_price_in_sol(swaps: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """(mint, last_price_in_sol): price of the latest trade whose price is not
    null (argMax skips nulls); null when every price is null.  Ties on time
    go to the higher price."""
    t = sol_trades(swaps).where(is_valid_key("mint"))
    latest = F.max(F.when(F.col("price").isNotNull(),
                          F.struct(F.col("block_time").alias("t"), F.col("price").alias("p"))))
    agg = t.groupBy("mint").agg(latest.alias("s")).select(
        "mint", F.col("s.p").alias("last_price_in_sol"))
    return restrict(agg, tokens)


def prices_in_usd(swaps: DataFrame, tokens: DataFrame | None = None,
                  sol_price: float | None = None) -> DataFrame:
    """(mint, price_usd) = latest SOL price x SOL/USD, 0.0 when null.  Tokens
    never traded against SOL are absent."""
    p = effective_sol_price(sol_price)
    last = latest_price_in_sol(swaps, tokens)
    return last.select("mint", F.coalesce(F.col("last_price_in_sol") * F.lit(p), F.lit(0.0))
                       .alias("price_usd"))


def recent_swaps(swaps: DataFrame, tokens: DataFrame | None = None,
                 n: int = RECENT_SWAPS_PER_TOKEN, stripes: int = 64) -> DataFrame:
    """(mint, recency_rank, base_coin, ..., block_time): each token's ``n``
    latest swaps on either side (a swap with base = quote counts once).

    Order: block_time desc, then every selected column desc (a total order up
    to identical rows).  The ranking has two levels.  First within (token, stripe of
    the input's tasks): Spark plans ``row_number() <= n`` as a partial
    WindowGroupLimit before the shuffle, so a task sends at most ``n`` rows of a
    token, and a hot token's rows meet in ``stripes`` tasks, not in one.  Then per
    token, over ``n * stripes`` rows at most and of wanted tokens only.  Which
    stripe a row is in does not change the result."""
    sides = swaps.select(F.explode(F.array_distinct(F.array("base_coin", "quote_coin"))).alias("mint"),
                         *SWAP_VALUE_COLUMNS, "block_time").where(is_valid_key("mint"))
    w = Window.partitionBy("mint").orderBy(
        F.col("block_time").desc(), *[F.col(c).desc() for c in SWAP_VALUE_COLUMNS])
    by_stripe = Window.partitionBy("mint", "_stripe").orderBy(
        F.col("block_time").desc(), *[F.col(c).desc() for c in SWAP_VALUE_COLUMNS])
    near = (sides.select("*", F.pmod(F.spark_partition_id(), F.lit(stripes)).alias("_stripe"))
            .select("*", F.row_number().over(by_stripe).alias("_rank"))
            .where(F.col("_rank") <= n).drop("_rank", "_stripe"))
    top = (restrict(near, tokens).select("*", F.row_number().over(w).alias("recency_rank"))
           .where(F.col("recency_rank") <= n))
    return top.select("mint", "recency_rank", *SWAP_VALUE_COLUMNS, "block_time")


def trade_liquidity(sol_price: float | None = None):
    """Single-swap liquidity in raw units, additive: SOL side x SOL price
    plus stable side x 1 (no decimals, no doubling)."""
    p = F.lit(effective_sol_price(sol_price))
    base, quote = F.col("base_coin"), F.col("quote_coin")
    b = F.col("base_pool_balance_after").cast("double")
    q = F.col("quote_pool_balance_after").cast("double")
    sol_part = F.when(is_sol(base), b * p).when(is_sol(quote), q * p).otherwise(F.lit(0.0))
    stable_part = F.when(is_stable(base), b).when(is_stable(quote), q).otherwise(F.lit(0.0))
    return sol_part + stable_part


def trade_price(sol_price: float | None = None):
    """Price of ``mint`` from one trade's amounts: 0 if either amount is 0;
    the counter side must be SOL (x SOL price) or a stablecoin (x 1)."""
    p = effective_sol_price(sol_price)
    base, quote = F.col("base_coin"), F.col("quote_coin")
    ba = F.col("base_coin_amount").cast("double")
    qa = F.col("quote_coin_amount").cast("double")
    safe_ba = F.when(ba != 0, ba)
    safe_qa = F.when(qa != 0, qa)
    in_quote = qa / safe_ba
    in_base = ba / safe_qa
    as_base = (F.when(is_sol(quote), in_quote * F.lit(p)).when(is_stable(quote), in_quote)
               .otherwise(F.lit(0.0)))
    as_quote = (F.when(is_sol(base), in_base * F.lit(p)).when(is_stable(base), in_base)
                .otherwise(F.lit(0.0)))
    return (F.when((ba == 0) | (qa == 0), F.lit(0.0))
            .when(F.col("mint") == base, as_base)
            .when(F.col("mint") == quote, as_quote)
            .otherwise(F.lit(0.0)))


def recent_trade_price(tokens: DataFrame, swaps: DataFrame, sol_price: float | None = None,
                       n: int = RECENT_SWAPS_PER_TOKEN) -> DataFrame:
    """(mint, liquidity, price_usd) for every token: among its ``n`` latest
    swaps (100, the operator's definition), the one with the highest positive single-swap liquidity (the most
    recent on ties) prices the token; 0.0 when none qualifies."""
    recent = recent_swaps(swaps, tokens, n).select("*", trade_liquidity(sol_price).alias("liquidity"))
    w = Window.partitionBy("mint").orderBy(F.col("liquidity").desc(), F.col("recency_rank").asc())
    best = (recent.where(F.col("liquidity") > 0)
            .select("*", F.row_number().over(w).alias("_rn"))
            .where(F.col("_rn") == 1)
            .select("mint", "liquidity", trade_price(sol_price).alias("price_usd")))
    out = keys_of(tokens).join(best, "mint", "left")
    return out.select("mint", F.coalesce("liquidity", F.lit(0.0)).alias("liquidity"),
                      F.coalesce("price_usd", F.lit(0.0)).alias("price_usd"))


RECENT_SWAPS_POINT_SQL = f"""
SELECT :token AS mint, {", ".join(SWAP_VALUE_COLUMNS)}, block_time
FROM {{swaps}}
WHERE base_coin = :token OR quote_coin = :token
ORDER BY block_time DESC, {", ".join(c + " DESC" for c in SWAP_VALUE_COLUMNS)}
LIMIT :n
"""


def recent_swaps_point(spark: SparkSession, swaps: DataFrame, token: str, n: int = RECENT_SWAPS_PER_TOKEN) -> DataFrame:
    """(mint, base_coin, ..., block_time): one token's ``n`` latest swaps, in the order of
    ``recent_swaps``.  A bound query: the filter on both coins reaches the scan, every task
    keeps its first ``n`` rows, and no other token's row is ever shuffled or ranked."""
    return bound_query(spark, RECENT_SWAPS_POINT_SQL, {"token": token, "n": int(n)}, {"swaps": swaps})


def token_price_point(spark: SparkSession, swaps: DataFrame, token: str, sol_price: float | None = None,
                      n: int = RECENT_SWAPS_PER_TOKEN) -> DataFrame:
    """(mint, liquidity, price_usd) of one token, always one row: the row that
    ``recent_trade_price`` has for it, 0.0 and 0.0 when no recent swap qualifies."""
    recent = recent_swaps_point(spark, swaps, token, n).select("*", trade_liquidity(sol_price).alias("liquidity"))
    best = (recent.where(F.col("liquidity") > 0)
            .orderBy(F.col("liquidity").desc(), F.col("block_time").desc(), *[F.col(c).desc() for c in SWAP_VALUE_COLUMNS])
            .limit(1).select("liquidity", trade_price(sol_price).alias("price_usd")))
    return best.agg(F.coalesce(F.max("liquidity"), F.lit(0.0)).alias("liquidity"),
                    F.coalesce(F.max("price_usd"), F.lit(0.0)).alias("price_usd")).select(F.lit(token).alias("mint"), "liquidity", "price_usd")


__all__ = ["sol_trades", "latest_price_in_sol", "prices_in_usd", "recent_swaps",
           "trade_liquidity", "trade_price", "recent_trade_price", "recent_swaps_point", "token_price_point"]
