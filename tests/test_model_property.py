"""The Spark pipeline against the brute-force model on random small inputs."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from ledgerlens.constants import SOL, USDC, USDT
from ledgerlens.plans.records import token_metrics

from builders import swap, tables
from model import records

COINS = [SOL, USDC, USDT, "T1", "T2", "T3"]
SOURCES = ["orca", "jupiter6_orca", "raydium_route_orca", "pumpfun_BondingCurve", "jupiter6X"]
T0 = datetime(2024, 1, 1)
times = st.integers(0, 5).map(lambda h: T0 + timedelta(hours=h))
amounts = st.sampled_from([0, 1, 7, 10**6, 3 * 10**9, 18446744073709551615])

mint_rows = st.lists(st.tuples(st.sampled_from(COINS + ["", "T9"]), amounts,
                               st.one_of(st.none(), times)), min_size=1, max_size=8)
burn_rows = st.lists(st.tuples(st.sampled_from(COINS), amounts, times), max_size=5)
swap_rows = st.lists(st.tuples(st.sampled_from(SOURCES), st.sampled_from(COINS), st.sampled_from(COINS),
                               amounts, amounts, amounts, amounts, times), max_size=12)
dec_rows = st.dictionaries(st.sampled_from(COINS + ["T9"]), st.sampled_from([0, 2, 6, 9]), max_size=4)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(mint_rows, burn_rows, swap_rows, dec_rows)
def test_pipeline_matches_model(spark, mints, burns, swaps, decimals):
    t = tables(spark, mints=mints, burns=burns, swaps=[swap(*s) for s in swaps],
               decimals=list(decimals.items()))
    got = {r.token_address: r for r in token_metrics(t).collect()}
    want = records(mints, burns, swaps, decimals)
    assert set(got) == set(want)
    for tok, w in want.items():
        g = got[tok]
        for k, v in w.items():
            assert getattr(g, k) == v, (tok, k, getattr(g, k), v)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(mint_rows, swap_rows)
def test_trade_prices_match_model(spark, mints, swaps):
    from ledgerlens.operators import pricing
    from ledgerlens.operators.discovery import discover_tokens
    from model import latest_sol_prices, recent_trade_prices
    t = tables(spark, mints=mints, swaps=[swap(*s) for s in swaps])
    tok = discover_tokens(t.mints)
    tokens = {m for m, _, _ in mints if m}
    got = {r.mint: r.last_price_in_sol for r in pricing.latest_price_in_sol(t.swaps, tok).collect()}
    assert got == latest_sol_prices(swaps, tokens)
    got2 = {r.mint: (r.liquidity, r.price_usd) for r in pricing.recent_trade_price(tok, t.swaps).collect()}
    assert got2 == recent_trade_prices(swaps, tokens)
