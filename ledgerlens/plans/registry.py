"""

Each entry takes (spark, sf_dir) and returns a lazy DataFrame over the
relations derived from the whole ``lineitem`` / ``part`` tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SOL
from ..operators import discovery, lifetimes, market, pools, pricing, supply
from ..sources.enrichment import account_metadata, decimals_from_batches, decimals_from_responses, metadata_from_batches
from ..session import new_folder
from ..sources.tables import TokenTables, derive_from_tpch, read_tables, write_raw
from . import records as tm

POINT_TOKEN = SOL          # the bound parameter of the single-token queries
FIRST_TOKENS = 100         # the limit of the limited discovery
REPRICE_SOL_USD = 150.0    # the SOL price handed to the repriced pool metrics


def _tables(spark: SparkSession, sf_dir: str) -> TokenTables:
    return derive_from_tpch(spark, sf_dir)


def _files(spark: SparkSession, sf_dir: str) -> TokenTables:
    root = new_folder(spark, "tables")
    write_raw(spark, sf_dir, root)
    return read_tables(spark, root)


def _tokens(t: TokenTables) -> DataFrame:
    return discovery.discover_tokens(t.mints)


def _dec_map(t: TokenTables) -> DataFrame:
    return supply.resolved_decimals(_tokens(t), t.token_decimals)


def q_token_discovery(spark, sf_dir):
    return _tokens(_tables(spark, sf_dir))


def q_token_discovery_limited(spark, sf_dir):
    return discovery.discover_tokens(_tables(spark, sf_dir).mints, limit=FIRST_TOKENS)


def q_token_supply_static(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return supply.token_supply(None, t.mints, t.burns)


def q_token_metrics_from_files(spark, sf_dir):
    """The path a user runs: uncleaned multi-file tables through ``read_tables``."""
    return tm.token_metrics(_files(spark, sf_dir))


def q_normalized_keys(spark, sf_dir):
    t = _tables(spark, sf_dir)
    one, zero = F.lit(1), F.lit(0)
    rows = (t.mints.select("mint", one.alias("m"), zero.alias("b"), zero.alias("s"))
            .unionByName(t.burns.select("mint", zero.alias("m"), one.alias("b"), zero.alias("s")))
            .unionByName(lifetimes.swap_sides(t.swaps)
                         .select("mint", zero.alias("m"), zero.alias("b"), one.alias("s"))))
    return rows.groupBy("mint").agg(F.sum("m").cast("bigint").alias("n_mint_rows"),
                                    F.sum("b").cast("bigint").alias("n_burn_rows"),
                                    F.sum("s").cast("bigint").alias("n_swap_sides"))


def q_canonical_source_counts(spark, sf_dir):
    return pools.canonical_source_counts(_tables(spark, sf_dir).swaps)


def q_pool_class_counts(spark, sf_dir):
    return pools.pool_class_counts(_tables(spark, sf_dir).swaps)


def q_minted_by_token(spark, sf_dir):
    return supply.minted_by_token(_tables(spark, sf_dir).mints)


def q_burned_by_token(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return supply.burned_by_token(t.burns, _tokens(t))


def q_token_supply(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return supply.token_supply(None, t.mints, t.burns, t.token_decimals)


def q_token_supply_point(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return supply.token_supply_point(spark, t.mints, t.burns, POINT_TOKEN)


def q_initial_minted_normalized(spark, sf_dir):
    return supply.initial_minted_normalized(_tables(spark, sf_dir).mints)


def q_burned_normalized(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return supply.burned_normalized(_tokens(t), t.burns, t.token_decimals)


def q_first_mints(spark, sf_dir):
    # the valid-key aggregate of mints is the token set itself: no restriction join
    return lifetimes.first_mints(_tables(spark, sf_dir).mints)


def q_first_swaps(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return lifetimes.first_swaps(t.swaps, _tokens(t))


def q_first_tx_dates(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return lifetimes.first_tx_dates(None, t.mints, t.swaps)


def q_first_tx_point(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return lifetimes.first_tx_point(spark, t.mints, t.swaps, POINT_TOKEN)


def q_latest_pool_state(spark, sf_dir):
    return pools.latest_pool_state(_tables(spark, sf_dir).swaps)


def q_candidate_pools(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return pools.candidate_pools(t.swaps, _dec_map(t))


def _sides(t: TokenTables, sol_price=None) -> DataFrame:
    return pools.pool_sides(t.swaps, _dec_map(t), sol_price)


def _valued(t: TokenTables) -> DataFrame:
    return pools.valued_pools(pools.candidate_pool_states(t.swaps, _dec_map(t)))


def q_pool_sides(spark, sf_dir):
    s = _sides(_tables(spark, sf_dir))
    return s.select("mint", *pools.POOL_KEYS, "token_is_base", "token_decimals",
                    "base_decimals", "quote_decimals")


def q_pool_balances(spark, sf_dir):
    s = _valued(_tables(spark, sf_dir))
    return s.select(*pools.POOL_KEYS, "base_decimals", "quote_decimals", "base_balance_norm", "quote_balance_norm")


def q_pool_liquidity(spark, sf_dir):
    s = _valued(_tables(spark, sf_dir))
    return s.select(*pools.POOL_KEYS, "is_bonding", "liquidity_usd")


def q_best_pool_metrics(spark, sf_dir):
    t = _tables(spark, sf_dir)
    tokens = _dec_map(t)  # the token set with its decimals feeds every branch
    return pools.best_pool_metrics(tokens, t.swaps, tokens)


def q_best_pool_metrics_repriced(spark, sf_dir):
    t = _tables(spark, sf_dir)
    tokens = _dec_map(t)
    return pools.best_pool_metrics(tokens, t.swaps, tokens, sol_price=REPRICE_SOL_USD)


def q_token_reserves(spark, sf_dir):
    t = _tables(spark, sf_dir)
    tokens = _dec_map(t)
    return pools.token_reserves(tokens, t.swaps, tokens)


def q_circulating_supply(spark, sf_dir):
    t = _tables(spark, sf_dir)
    sup = supply.token_supply(None, t.mints, t.burns, t.token_decimals)
    # the supply frame is left-joined to the reserves, so they need no token set of their own
    res = pools.reserves_by_token(pools.pool_sides(t.swaps, _dec_map(t)))
    return supply.circulating_supply(sup, res)


def q_market_caps(spark, sf_dir):
    t = _tables(spark, sf_dir)
    sup = supply.token_supply(None, t.mints, t.burns, t.token_decimals)
    # left join on the supplies: prices of other coins fall away there
    return market.market_caps(sup, pricing.prices_in_usd(t.swaps))


def q_latest_price_in_sol(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return pricing.latest_price_in_sol(t.swaps, _tokens(t))


def q_prices_in_usd(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return pricing.prices_in_usd(t.swaps, _tokens(t))


def q_recent_swaps(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return pricing.recent_swaps(t.swaps, _tokens(t))


def q_trade_liquidity(spark, sf_dir):
    s = _tables(spark, sf_dir).swaps
    return s.select("base_coin", "quote_coin", "block_time", "base_pool_balance_after",
                    "quote_pool_balance_after", pricing.trade_liquidity().alias("liquidity"))


def q_recent_trade_price(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return pricing.recent_trade_price(_tokens(t), t.swaps)


def q_recent_swaps_point(spark, sf_dir):
    return pricing.recent_swaps_point(spark, _tables(spark, sf_dir).swaps, POINT_TOKEN)


def q_token_price_point(spark, sf_dir):
    return pricing.token_price_point(spark, _tables(spark, sf_dir).swaps, POINT_TOKEN)


def q_decimals_from_responses(spark, sf_dir):
    return decimals_from_responses(_tables(spark, sf_dir).decimals_responses)


def q_account_metadata(spark, sf_dir):
    return account_metadata(_tables(spark, sf_dir).metadata_accounts)


def q_decimals_from_batches(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return decimals_from_batches(t.decimals_requests, t.decimals_batches)


def q_metadata_from_batches(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return metadata_from_batches(t.metadata_requests, t.metadata_batches)


def q_token_metrics(spark, sf_dir):
    return tm.token_metrics(_tables(spark, sf_dir))


def q_token_metrics_limited(spark, sf_dir):
    """A run over the first tokens, whose keys restrict every scan of the written tables."""
    return tm.token_metrics(_files(spark, sf_dir), limit=FIRST_TOKENS)


def q_token_metrics_enriched(spark, sf_dir):
    return tm.token_metrics_enriched(_tables(spark, sf_dir))


def q_run_summary(spark, sf_dir):
    return tm.run_summary(_tables(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
