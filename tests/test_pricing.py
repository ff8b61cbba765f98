from ledgerlens.constants import SOL, USDC
from ledgerlens.operators import pricing
from ledgerlens.operators.discovery import discover_tokens

from builders import swap, tables
from conftest import ts


def test_latest_non_null_price_wins(spark):
    t = tables(spark, mints=[("T1", 1, ts(1))],
               swaps=[swap("a", "T1", SOL, 10, 20, 1, 1, ts(1)),      # price 2.0
                      swap("a", "T1", SOL, 0, 5, 1, 1, ts(2))])       # latest: NULLIF -> null
    tok = discover_tokens(t.mints)
    r = pricing.latest_price_in_sol(t.swaps, tok).first()
    assert r.last_price_in_sol == 2.0
    assert pricing.prices_in_usd(t.swaps, tok).first().price_usd == 2.0 * 190.0


def test_only_null_prices(spark):
    t = tables(spark, mints=[("T1", 1, ts(1)), ("T2", 1, ts(1))],
               swaps=[swap("a", "T1", SOL, 0, 5, 1, 1, ts(1))])
    tok = discover_tokens(t.mints)
    got = {r.mint: r.price_usd for r in pricing.prices_in_usd(t.swaps, tok).collect()}
    assert got == {"T1": 0.0}      # T2 never traded against SOL: absent


def test_best_of_101st_swap_not_chosen(spark):
    rows = [swap("a", "T1", SOL, 1, 1, 1, 1, ts(1, 0))]                 # oldest: best liquidity
    rows[0] = swap("a", "T1", SOL, 1, 3, 1, 10**12, ts(1, 0))
    rows += [swap("a", "T1", SOL, 1, 2, 1, 10 + i, ts(2, 0)) for i in range(100)]
    t = tables(spark, mints=[("T1", 1, ts(1))], swaps=rows)
    tok = discover_tokens(t.mints)
    assert pricing.recent_swaps(t.swaps, tok).count() == 100
    r = pricing.recent_trade_price(tok, t.swaps).first()
    assert r.price_usd == 2.0 * 190.0 and r.liquidity == 109 * 190.0


def test_recent_swaps_without_anchor_give_zero(spark):
    t = tables(spark, mints=[("T1", 1, ts(1))], swaps=[swap("a", "T1", "T7", 1, 1, 9, 9, ts(1))])
    r = pricing.recent_trade_price(discover_tokens(t.mints), t.swaps).first()
    assert (r.price_usd, r.liquidity) == (0.0, 0.0)


def test_base_equals_quote_listed_once(spark):
    t = tables(spark, mints=[(SOL, 1, ts(1))], swaps=[swap("a", SOL, SOL, 1, 1, 1, 1, ts(1))])
    assert pricing.recent_swaps(t.swaps, discover_tokens(t.mints)).count() == 1


def test_trade_price_stable_counter(spark):
    t = tables(spark, mints=[("T1", 1, ts(1))], swaps=[swap("a", USDC, "T1", 8, 4, 50, 1, ts(1))])
    r = pricing.recent_trade_price(discover_tokens(t.mints), t.swaps).first()
    assert r.price_usd == 8 / 4 and r.liquidity == 50.0
