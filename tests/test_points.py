"""Bound queries, the point price, and runs over a bounded set of tokens."""

import re
import tempfile
from decimal import Decimal

import pytest
from builders import D, swap, tables
from conftest import ts

from ledgerlens.constants import SOL, USDC
from ledgerlens.operators import discovery, lifetimes, pricing, supply
from ledgerlens.operators.bound import bound_query
from ledgerlens.plans.records import build, limited, records_of, token_metrics
from ledgerlens.sources.tables import derive_from_tpch, read_tables, write_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean(spark):
    d = tempfile.mkdtemp(prefix="ll-point-")
    write_tables(derive_from_tpch(spark, SF), d)
    return read_tables(spark, d, normalize_keys=False)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bound_query_binds_values_and_names_relations(spark):
    t = tables(spark, mints=[("a'; drop", 5, ts(1)), ("b", 7, ts(2)), (":token", 9, ts(3))], burns=[("b", 1, None)])
    one = "SELECT mint, amount FROM {mints} WHERE mint = :token"
    for key, amount in (("a'; drop", 5), ("b", 7), (":token", 9)):
        assert [(r.mint, r.amount) for r in bound_query(spark, one, {"token": key}, t).collect()] == [(key, D(amount))]
    assert bound_query(spark, one, {"token": None}, t).count() == 0
    both = "SELECT m.mint FROM {mints} m JOIN {burns} b ON m.mint = b.mint WHERE m.amount >= :least AND m.block_time < :until"
    assert [r.mint for r in bound_query(spark, both, {"least": Decimal(6), "until": ts(9)}, t).collect()] == ["b"]
    some = "SELECT count(*) AS n FROM {mints} WHERE array_contains(:tokens, mint)"
    assert bound_query(spark, some, {"tokens": ["b", "zz", ":token"]}, t).first().n == 2
    assert bound_query(spark, some, {"tokens": []}, t).first().n == 0
    assert bound_query(spark, "SELECT :x + 1 AS y", {"x": 41}).first().y == 42


def test_bound_query_takes_only_whole_relations(spark):
    t = tables(spark, mints=[("a", 5, ts(1))])
    for statement in ("SELECT * FROM {nothing}", "SELECT * FROM {decimals_batches}", "SELECT * FROM {mints.columns}", "SELECT * FROM {mints!r}",
                      "SELECT * FROM {0}", "SELECT * FROM {}"):
        with pytest.raises(ValueError):
            bound_query(spark, statement, tables=t)
    with pytest.raises(ValueError):
        bound_query(spark, "SELECT * FROM {mints}", tables={"mints": "mints; drop"})
    with pytest.raises(Exception, match="(?i)parameter"):
        bound_query(spark, "SELECT * FROM {mints} WHERE mint = :token", {}, t).collect()


def test_point_price_equals_the_batched_one(spark, clean):
    batched = {r.mint: r for r in pricing.recent_trade_price(discovery.discover_tokens(clean.mints), clean.swaps).collect()}
    ranked = pricing.recent_swaps(clean.swaps).cache()
    for token in (SOL, USDC, "T00000010", "T00000041", sorted(batched)[-1]):
        point = pricing.token_price_point(spark, clean.swaps, token).collect()
        assert len(point) == 1 and point[0] == batched[token]
        want = [tuple(r)[:1] + tuple(r)[2:] for r in ranked.where(f"mint = '{token}'").orderBy("recency_rank").collect()]
        assert [tuple(r) for r in pricing.recent_swaps_point(spark, clean.swaps, token).collect()] == want


def test_point_price_of_odd_swaps(spark):
    """Ties go to the row that ranks first; no positive liquidity, no swaps and null times give defined results."""
    s = [swap("x", "A", SOL, 10, 20, 5, 100, ts(3)), swap("x", "A", SOL, 10, 40, 5, 100, ts(4)), swap("x", SOL, "A", 1, 2, 100, 5, ts(2)),
         swap("x", "A", "B", 1, 1, 9, 9, ts(9)), swap("x", "B", "A", 1, 1, 0, 0, None), swap("x", "A", "A", 1, 1, 3, 3, ts(1))]
    swaps = tables(spark, swaps=s).swaps
    price = lambda t, **kw: tuple(pricing.token_price_point(spark, swaps, t, **kw).first())
    assert price("A") == ("A", 19000.0, 40 / 10 * 190.0) and price("A", sol_price=10.0) == ("A", 1000.0, 40.0)
    assert price("B") == ("B", 0.0, 0.0) and price("none") == ("none", 0.0, 0.0) and price("A", n=1) == ("A", 0.0, 0.0)
    rows = pricing.recent_swaps_point(spark, swaps, "A").collect()
    assert len(rows) == 6 and [r.block_time for r in rows] == [ts(9), ts(4), ts(3), ts(2), ts(1), None]


def test_point_plans_filter_at_the_scan(spark, clean):
    p = plan_of(pricing.recent_swaps_point(spark, clean.swaps, "T00000010"))
    assert "TakeOrderedAndProject" in p and "Window" not in p and "Exchange" not in p
    assert re.search(r"PushedFilters: \[Or\(EqualTo\(base_coin,T00000010\),EqualTo\(quote_coin,T00000010\)\)", p)
    for df, column in ((supply.token_supply_point(spark, clean.mints, clean.burns, "T1"), "mint"),
                       (lifetimes.first_tx_point(spark, clean.mints, clean.swaps, "T1"), "mint")):
        assert f"EqualTo({column},T1)" in plan_of(df)


def test_limited_run_equals_the_cut_of_a_whole_one(spark, clean):
    whole = {r.token_address: r for r in token_metrics(clean).collect()}
    tokens = [r.mint for r in discovery.discover_tokens(clean.mints, 12).collect()]
    cut, rest = limited(clean, 12)
    assert rest is None and discovery.first_tokens(clean.mints, 12) == tokens
    got = {r.token_address: r for r in token_metrics(clean, limit=12).collect()}
    assert set(got) == set(tokens) & set(whole) and len(got) > 5
    joined = records_of(build(clean, decimals=clean.token_decimals, limit=12))  # the same run, cut after the aggregates
    assert got == {r.token_address: r for r in joined.collect()}
    assert token_metrics(clean, limit=0).count() == 0
    big = discovery.MAX_PUSHED_TOKENS + 1
    assert limited(clean, big) == (clean, big) and token_metrics(clean, limit=big).count() == len(whole)
    with pytest.raises(ValueError):
        discovery.first_tokens(clean.mints, big)
    with pytest.raises(ValueError):
        discovery.only_tokens(clean, [str(i) for i in range(big)])


def test_limited_run_drops_other_tokens_at_the_scan(spark, clean):
    """Every event scan has the keys as a pushed filter: no other row reaches an aggregate or a shuffle."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.maxMetadataStringLength": "9999"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        p = token_metrics(clean, limit=12)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln]
    events = [ln for ln in scans if re.search(r"/(mints|burns|swaps)\.parquet", ln)]
    assert len(events) >= 4 and "LeftSemi" not in p
    for ln in events:
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", ln).group(1)
        assert "In(mint" in pushed or ("base_coin" in pushed and "quote_coin" in pushed and "In(" in pushed), ln
