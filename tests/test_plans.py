"""Physical-plan properties."""

import re
import tempfile

import pytest

from ledgerlens.operators import pools
from ledgerlens.plans import registry
from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources.tables import derive_from_tpch, read_tables, write_tables

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    """The adaptive plan that ran: the frame's own execution, after its action."""
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in p or "isFinalPlan=true" in p
    return p


def static_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def above(lines: list[str], i: int) -> str:
    """The nearest ancestor of node i that is no sort or projection."""
    d = depth(lines[i])
    for ln in reversed(lines[:i]):
        if depth(ln) < d:
            d = depth(ln)
            if not re.search(r"\b(Sort|Project|InputAdapter) ", ln):
                return ln
    return ""


@pytest.fixture(scope="module")
def clean(spark):
    d = tempfile.mkdtemp(prefix="ll-plan-")
    write_tables(derive_from_tpch(spark, SF), d)
    return read_tables(spark, d, normalize_keys=False)


@pytest.fixture
def at_scale(spark, clean, monkeypatch):
    """Queries over cleaned files, planned as for big tables: no broadcasts by size, static plan."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    monkeypatch.setattr(registry, "_tables", lambda spark, sf_dir: clean)
    yield lambda name: static_plan(QUERIES[name](spark, SF))
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_cartesian_or_python(spark, name):
    p = final_plan(QUERIES[name](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["recent_swaps", "recent_trade_price"])
def test_topk_has_two_levels(at_scale, name):
    """At most n rows of a token leave a task; a token's rows meet in its stripes before they meet."""
    lines = at_scale(name).splitlines()
    partial = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln and "_stripe" in ln]
    assert partial
    for i in partial:
        assert re.search(r"Exchange hashpartitioning\(mint#\d+, _stripe#\d+", above(lines, i))
    finals = [ln for ln in lines if "WindowGroupLimit" in ln and "Final" in ln]
    assert any("_stripe" in ln for ln in finals) and any("_stripe" not in ln for ln in finals)


def test_flagship_reads_each_table_as_often_as_needed(at_scale):
    p = at_scale("token_metrics")
    scans = re.findall(r"FileScan parquet .*?Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\]", p)
    counts = {t: scans.count(t) for t in set(scans)}
    # swaps: first-seen and pools; mints: records, pool map and (filtered to the anchors) anchor rows
    assert counts["swaps"] == 2 and counts["burns"] == 1 and counts["mints"] <= 3
    assert re.search(r"PushedFilters: \[.*Or\(In\(base_coin", p)  # the anchor filter reaches the Parquet reader
    assert p.count("SortMergeJoin") >= 5


def test_anchor_filter_reaches_the_reader_of_clean_tables(spark, clean):
    p = static_plan(pools.latest_pool_state(clean.swaps))
    assert re.search(r"PushedFilters: \[.*Or\(In\(base_coin", p)
    schema = p.split("ReadSchema:")[1]
    assert "base_coin_amount" not in schema and "base_pool_balance_after" in schema


@pytest.mark.parametrize("name", ["token_metrics", "best_pool_metrics", "token_reserves", "candidate_pools"])
def test_no_shuffle_on_a_hot_anchor(at_scale, name):
    p = at_scale(name)
    assert not re.search(r"Exchange hashpartitioning\((base|quote)_coin#\d+, \d+\)", p)
    assert re.search(r"Exchange hashpartitioning\(_other#\d+", p)


@pytest.mark.parametrize("name,partial", [
    ("latest_pool_state", "partial_max(struct("),
    ("first_swaps", "partial_min(block_time"),
    ("latest_price_in_sol", "partial_max(CASE WHEN isnotnull(price"),
    ("token_reserves", "partial_sum(CASE WHEN token_is_base"),
    ("normalized_keys", "partial_sum("),
])
def test_hot_keys_reduced_before_shuffle(at_scale, name, partial):
    """A key holding a third of the rows is pre-aggregated by the task that shuffles it."""
    lines = at_scale(name).splitlines()
    found = [i for i, ln in enumerate(lines) if partial in ln]
    assert found
    for i in found:
        assert "Exchange hashpartitioning" in above(lines, i), lines[i]


@pytest.mark.parametrize("name", ["token_metrics", "pool_sides", "first_swaps", "burned_by_token"])
def test_no_filter_repeats_the_derivation_of_a_key(spark, name):
    """Filters run on delivered keys; copied over their derivation they outgrew what the JVM compiles."""
    filters = [ln for ln in static_plan(QUERIES[name](spark, SF)).splitlines() if re.search(r"[+:]- (\*\(\d+\) )?Filter ", ln)]
    assert filters
    assert not [f for f in filters if "xxhash64" in f]


@pytest.mark.parametrize("name", ["candidate_pools", "pool_liquidity", "circulating_supply", "pool_sides", "best_pool_metrics"])
def test_keys_are_normalised_once(spark, name):
    """A filter on normalised keys, of derived tables or of files, runs on the result."""
    filters = [ln for ln in static_plan(QUERIES[name](spark, SF)).splitlines() if re.search(r"[+:]- (\*\(\d+\) )?Filter ", ln)]
    assert any(re.search(r"coin#\d+ IN ", f) for f in filters)
    assert not [f for f in filters if "makeValid" in f]


def test_pool_states_sort_by_one_number(at_scale):
    """Sources and anchors are the same in most rows: the sorts of the aggregate are led by a hash."""
    p = at_scale("latest_pool_state")
    sorts = re.findall(r"Sort \[(\w+)#\d+(L?) ", p)
    assert len(sorts) == 2 and all(long for _, long in sorts)


@pytest.mark.parametrize("name", ["candidate_pools", "pool_liquidity"])
def test_anchor_rows_share_the_map_of_the_pools(at_scale, name):
    p = at_scale(name)
    assert len(re.findall(r"FileScan parquet .*?/mints\.parquet\]", p)) == 1
    assert "ReusedExchange" in p


def test_anchor_rows_are_those_of_the_map(spark):
    """Anchors in the map, absent from it, and in it without decimals."""
    from builders import SOL, USDC, USDT, swap, tables
    from conftest import ts

    swaps = tables(spark, swaps=[swap("raydium_amm", SOL, USDC, 1, 1, 5, 7, ts(1)), swap("raydium_amm", USDT, "T9", 1, 1, 5, 7, ts(1)),
                                 swap("raydium_amm", USDT, USDT, 1, 1, 5, 7, ts(1)), swap("raydium_amm", "T1", USDT, 1, 1, 5, 7, ts(1))]).swaps
    known = spark.createDataFrame([(SOL, 8), (USDT, None), ("T1", 3)], "mint string, decimals int")
    got = {(r.base_coin, r.quote_coin): (r.base_is_token, r.quote_is_token, r.base_decimals, r.quote_decimals)
           for r in pools.candidate_pool_states(swaps, known).collect()}
    assert got == {(SOL, USDC): (True, False, 8, 6), ("T1", USDT): (True, False, 3, 6)}
