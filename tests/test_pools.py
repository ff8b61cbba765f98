from ledgerlens.constants import SOL, USDC
from ledgerlens.operators import pools, supply
from ledgerlens.operators.discovery import discover_tokens

from builders import D, swap, tables
from conftest import ts


def _dm(t):
    return supply.resolved_decimals(discover_tokens(t.mints), t.token_decimals)


def test_same_time_two_states_never_mixed(spark):
    t = tables(spark, swaps=[swap("orca", "T1", SOL, 1, 1, 1, 9, ts(1)),
                             swap("orca", "T1", SOL, 1, 1, 2, 3, ts(1))])
    rows = pools.latest_pool_state(t.swaps).collect()
    assert [(r.last_base_balance, r.last_quote_balance) for r in rows] == [(2, 3)]


def test_latest_state_empty_pool_disappears(spark):
    t = tables(spark, swaps=[swap("orca", "T1", SOL, 1, 1, 5, 5, ts(1)),
                             swap("orca", "T1", SOL, 1, 1, 0, 5, ts(2))])
    assert pools.live_pools(t.swaps).count() == 0


def test_pool_is_triple_with_canonical_source(spark):
    t = tables(spark, swaps=[swap("jupiter6_orca", "T1", SOL, 1, 1, 5, 5, ts(1)),
                             swap("orca", "T1", SOL, 1, 1, 7, 7, ts(2)),
                             swap("orca", SOL, "T1", 1, 1, 8, 8, ts(2))])
    rows = sorted((r.canonical_source, r.base_coin, r.last_base_balance)
                  for r in pools.latest_pool_state(t.swaps).collect())
    assert rows == [("orca", SOL, 8), ("orca", "T1", 7)]


def test_priority_beats_bonding_and_ties_by_source(spark):
    t = tables(spark,
               mints=[("T1", 1, ts(1))],
               swaps=[swap("pumpfun_BondingCurve", "T1", SOL, 1, 1, 10**6, 100 * 10**9, ts(1)),
                      swap("b", "T1", USDC, 1, 1, 10**6, 10**6, ts(1)),
                      swap("a", "T1", USDC, 1, 1, 10**6, 10**6, ts(1))])
    tok = discover_tokens(t.mints)
    r = pools.best_pool_metrics(tok, t.swaps, _dm(t)).first()
    assert r.source == "a" and r.liquidity_usd == 2.0 and r.price_usd == 1.0


def test_token_without_pool_gets_defaults(spark):
    t = tables(spark, mints=[("T9", 1, ts(1))], swaps=[swap("a", "T1", USDC, 1, 1, 5, 5, ts(1))])
    r = pools.best_pool_metrics(discover_tokens(t.mints), t.swaps, _dm(t)).first()
    assert (r.mint, r.source, r.liquidity_usd, r.price_usd) == ("T9", "", 0.0, 0.0)


def test_sol_sol_pool_reserves_add_both_sides(spark):
    t = tables(spark, mints=[(SOL, 1, ts(1))],
               swaps=[swap("a", SOL, SOL, 1, 1, 3 * 10**9, 4 * 10**9, ts(1))])
    tok = discover_tokens(t.mints)
    r = pools.token_reserves(tok, t.swaps, _dm(t)).first()
    assert r.reserves == 7.0


def test_anchor_token_priced_against_other_side(spark):
    # pool (SOL, T1): T1 is not stable, so its units count as $1 (reference parity)
    t = tables(spark, mints=[(SOL, 1, ts(1)), ("T1", 1, ts(1))],
               swaps=[swap("a", SOL, "T1", 1, 1, 2 * 10**9, 50 * 10**6, ts(1))])
    tok = discover_tokens(t.mints)
    got = {r.mint: r.price_usd for r in pools.best_pool_metrics(tok, t.swaps, _dm(t)).collect()}
    assert got[SOL] == 50.0 / 2.0
    assert got["T1"] == (2.0 * 190.0) / 50.0


def test_candidacy_needs_anchor_counter(spark):
    # (SOL, T5): only SOL is a token, its counter T5 is no anchor -> not a candidate
    t = tables(spark, mints=[(SOL, 1, ts(1))],
               swaps=[swap("a", SOL, "T5", 1, 1, 10, 10, ts(1))])
    assert pools.candidate_pools(t.swaps, _dm(t)).count() == 0
    # once T5 is a token, the pool is offered to both sides
    t2 = tables(spark, mints=[(SOL, 1, ts(1)), ("T5", 1, ts(1))],
                swaps=[swap("a", SOL, "T5", 1, 1, 10, 10, ts(1))])
    sides = pools.pool_sides(t2.swaps, _dm(t2))
    assert sorted(r.mint for r in sides.collect()) == sorted([SOL, "T5"])


def test_missing_decimals_defaults(spark):
    t = tables(spark, mints=[("T1", 1, ts(1))],
               swaps=[swap("a", "T1", SOL, 1, 1, 10**6, 10**9, ts(1))])
    s = pools.pool_sides(t.swaps, _dm(t)).first()
    assert (s.base_decimals, s.quote_decimals) == (6, 9)
    assert s.base_balance_norm == 1.0 and s.quote_balance_norm == 1.0
    assert s.liquidity_usd == 1.0 * 190.0 * 2.0


def test_token_decimals_used_for_pool_side(spark):
    t = tables(spark, mints=[("T1", 1, ts(1))], decimals=[("T1", 2)],
               swaps=[swap("a", "T1", USDC, 1, 1, 500, 10**6, ts(1))])
    s = pools.pool_sides(t.swaps, _dm(t)).first()
    assert s.base_decimals == 2 and s.base_balance_norm == 5.0 and s.price_usd == 1.0 / 5.0


def test_best_pool_dominates_its_class_on_fixture(spark):
    """Over the whole fixture: no side of a token beats its chosen pool."""
    from pyspark.sql import functions as F
    from ledgerlens.sources.tables import derive_from_tpch
    t = derive_from_tpch(spark, "/root/testdata/sf0.001")
    dm = _dm(t)
    sides = pools.pool_sides(t.swaps, dm)
    best = pools.best_pools(sides)
    chosen = best.join(sides.select("mint", F.col("canonical_source").alias("source"),
                                    "liquidity_usd", "is_bonding").dropDuplicates(),
                       ["mint", "source", "liquidity_usd"])
    better = (sides.alias("s").join(chosen.alias("c"), "mint")
              .where((F.col("s.is_bonding") < F.col("c.is_bonding"))
                     | ((F.col("s.is_bonding") == F.col("c.is_bonding"))
                        & (F.col("s.liquidity_usd") > F.col("c.liquidity_usd")))))
    assert best.count() > 0 and better.count() == 0


def test_latest_state_skips_swaps_with_a_null_balance(spark):
    """Both balances come from one row, so a row that lacks one is not a state."""
    from ledgerlens.operators.pools import latest_pool_state
    from ledgerlens.schemas import SWAPS
    from ledgerlens.sources.tables import conform_swaps

    rows = [("s", "T1", SOL, D(1), D(1), D(10), D(20), ts(1)), ("s", "T1", SOL, D(1), D(1), None, D(30), ts(2)),
            ("s", "T1", SOL, D(1), D(1), D(40), None, ts(3)), ("s", "T2", SOL, D(1), D(1), None, None, ts(3))]
    got = latest_pool_state(conform_swaps(spark.createDataFrame(rows, SWAPS))).collect()
    assert [(r.base_coin, r.last_base_balance, r.last_quote_balance) for r in got] == [("T1", 10, 20)]
