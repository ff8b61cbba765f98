from decimal import Decimal

from ledgerlens.constants import SOL
from ledgerlens.operators import lifetimes, supply
from ledgerlens.operators.discovery import discover_tokens

from builders import swap, tables
from conftest import ts

U64 = 18446744073709551615


def test_discovery_drops_invalid_and_normalises(spark):
    t = tables(spark, mints=[("T1\x00\x00", 1, ts(1)), (" T1 ", 1, ts(1)), ("", 1, ts(1)),
                             (None, 1, ts(1)), ("T2", 1, ts(1))])
    assert sorted(r.mint for r in discover_tokens(t.mints).collect()) == ["T1", "T2"]
    assert [r.mint for r in discover_tokens(t.mints, limit=1).collect()] == ["T1"]


def test_unsigned_64_bit_sums_do_not_overflow(spark):
    t = tables(spark, mints=[("T1", U64, ts(1)), ("T1", U64, ts(2))])
    r = supply.minted_by_token(t.mints).first()
    assert r.minted_raw == Decimal(2 * U64)


def test_burned_above_minted_gives_zero_supply(spark):
    t = tables(spark, mints=[("T1", 5, ts(1))], burns=[("T1", 8, ts(1))])
    tok = discover_tokens(t.mints)
    r = supply.token_supply(tok, t.mints, t.burns, t.token_decimals).first()
    assert r.supply == 0.0 and r.minted_raw == 5 and r.burned_raw == 8


def test_supply_decimals_defaults(spark):
    t = tables(spark, mints=[("T1", 10**7, ts(1)), (SOL, 10**9, ts(1))])
    tok = discover_tokens(t.mints)
    with_map = {r.mint: r.supply for r in supply.token_supply(tok, t.mints, t.burns, t.token_decimals).collect()}
    static = {r.mint: r.supply for r in supply.token_supply(tok, t.mints, t.burns, None).collect()}
    assert with_map == {"T1": 10.0, SOL: 1.0}        # resolved map: default 6, SOL preset 9
    assert static == {"T1": 0.01, SOL: 1.0}          # static table: default 9


def test_point_supply(spark):
    t = tables(spark, mints=[("T1", 5, ts(1)), ("T2", 7, ts(1))], burns=[("T1", 2, ts(1))])
    r = supply.token_supply_point(spark, t.mints, t.burns, "T1").first()
    assert r.supply_raw == 3
    assert supply.token_supply_point(spark, t.mints, t.burns, "nope").first().supply_raw == 0


def test_circulating_never_negative(spark):
    sup = spark.createDataFrame([("T1", 5.0), ("T2", 5.0)], "mint string, supply double")
    res = spark.createDataFrame([("T1", 9.0)], "mint string, reserves double")
    got = {r.mint: r.circulating_supply for r in supply.circulating_supply(sup, res).collect()}
    assert got == {"T1": 0.0, "T2": 5.0}


def test_first_dates_from_swap_mint_or_neither(spark):
    t = tables(spark,
               mints=[("M", 1, ts(5)), ("S", 1, None), ("N", 1, None), ("B", 1, ts(3))],
               swaps=[swap("a", "S", SOL, 1, 1, 1, 1, ts(4)), swap("a", SOL, "B", 1, 1, 1, 1, ts(2))])
    tok = discover_tokens(t.mints)
    got = {r.mint: r.first_tx_date for r in lifetimes.first_tx_dates(tok, t.mints, t.swaps).collect()}
    assert got == {"M": ts(5), "S": ts(4), "N": None, "B": ts(2)}
    p = lifetimes.first_tx_point(spark, t.mints, t.swaps, "B").first()
    assert p.first_tx_date == ts(2)


def test_duplicate_decimal_rows_do_not_duplicate_tokens(spark):
    t = tables(spark, mints=[("T1", 10**6, ts(1))], decimals=[("T1", 6), (" T1", 3)])
    rows = supply.token_supply(discover_tokens(t.mints), t.mints, t.burns, t.token_decimals).collect()
    assert len(rows) == 1 and rows[0].decimals == 6


def test_epoch_second_block_times(spark):
    from ledgerlens.sources.tables import conform_mints
    df = spark.createDataFrame([("T1", 5, 1704067200)], "mint string, amount long, block_time long")
    r = conform_mints(df).first()
    assert str(r.block_time).startswith("2024-01-01")
