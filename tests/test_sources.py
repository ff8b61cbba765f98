import tempfile
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import (BinaryType, DecimalType, StructField, StructType, TimestampNTZType)

from ledgerlens.plans.records import token_metrics
from ledgerlens.sources.tables import derive_from_tpch, read_tables, write_tables

SF = "/root/testdata/sf0.001"


def test_binary_padded_keys_normalised_on_read(spark):
    d = tempfile.mkdtemp(prefix="ll-src-")
    key = StructType([StructField("mint", BinaryType()), StructField("amount", DecimalType(20, 0)),
                      StructField("block_time", TimestampNTZType())])
    t = datetime(2024, 1, 1)
    rows = [(bytearray(b"T1\x00\x00\x00"), Decimal(5), t), (bytearray(b" T1\xff"), Decimal(7), t),
            (bytearray(b"\x00\x00"), Decimal(1), t)]
    spark.createDataFrame(rows, key).write.parquet(f"{d}/mints.parquet")
    spark.createDataFrame([], key).write.parquet(f"{d}/burns.parquet")
    swaps = spark.createDataFrame([], "source string, base_coin binary, quote_coin binary, "
                                      "base_coin_amount decimal(20,0), quote_coin_amount decimal(20,0), "
                                      "base_pool_balance_after decimal(20,0), "
                                      "quote_pool_balance_after decimal(20,0), block_time timestamp_ntz")
    swaps.write.parquet(f"{d}/swaps.parquet")
    tables = read_tables(spark, d)
    got = sorted((r.mint, r.amount) for r in tables.mints.collect())
    assert got == [("", 1), ("T1", 5), ("T1", 7)]
    out = token_metrics(tables).collect()
    assert [(r.token_address, r.supply) for r in out] == [("T1", 12 / 10**6)]


def test_clean_copy_gives_the_same_records(spark):
    derived = derive_from_tpch(spark, SF)
    d = tempfile.mkdtemp(prefix="ll-src-")
    write_tables(derived, d)
    clean = read_tables(spark, d, normalize_keys=False)
    assert sorted(token_metrics(clean).collect()) == sorted(token_metrics(derived).collect())


def _minimal(spark, d):
    t = datetime(2024, 1, 1)
    spark.createDataFrame([("T1", Decimal(5), t)], "mint string, amount decimal(20,0), block_time timestamp_ntz").write.parquet(f"{d}/mints.parquet")
    spark.createDataFrame([], "mint string, amount decimal(20,0)").write.parquet(f"{d}/burns.parquet")
    spark.createDataFrame([(b"raydium_amm\x00\x00", "T1", "T2", *[Decimal(1)] * 4, t)],
                          "source binary, base_coin string, quote_coin string, base_coin_amount decimal(20,0), "
                          "quote_coin_amount decimal(20,0), base_pool_balance_after decimal(20,0), "
                          "quote_pool_balance_after decimal(20,0), block_time timestamp_ntz").write.parquet(f"{d}/swaps.parquet")


def test_absent_lookup_warns_and_unreadable_one_raises(spark, caplog):
    import os

    d = tempfile.mkdtemp(prefix="ll-src-")
    _minimal(spark, d)
    with caplog.at_level("WARNING"):
        assert read_tables(spark, d).token_decimals is None
    assert "token_decimals" in caplog.text
    os.mkdir(f"{d}/token_decimals.parquet")  # there, but without a schema
    with pytest.raises(AnalysisException):
        read_tables(spark, d)
    d = tempfile.mkdtemp(prefix="ll-src-")
    _minimal(spark, d)
    spark.createDataFrame([("T1", 9)], "mint string, dec int").write.parquet(f"{d}/token_decimals.parquet")
    with pytest.raises(ValueError, match="lacks the columns decimals"):
        read_tables(spark, d)
    with pytest.raises(FileNotFoundError):
        read_tables(spark, tempfile.mkdtemp(prefix="ll-src-"))


def test_sources_lose_their_padding(spark):
    d = tempfile.mkdtemp(prefix="ll-src-")
    _minimal(spark, d)
    assert [r.source for r in read_tables(spark, d).swaps.collect()] == ["raydium_amm"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """Zoneless, zoned and epoch times of one instant are stored as the same UTC time."""
    from ledgerlens.sources.tables import conform_mints

    old = spark.conf.get("spark.sql.session.timeZone")
    epoch = 1704067200  # 2024-01-01 00:00:00 UTC
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        base = spark.range(1).selectExpr("'T' as mint", "cast(1 as decimal(20,0)) as amount",
                                         "timestamp_ntz'2024-01-01 00:00:00' as ntz", f"timestamp_seconds({epoch}) as zoned",
                                         f"{epoch}L as epoch", f"cast({epoch} as int) as epoch32")
        for c in ("ntz", "zoned", "epoch", "epoch32"):
            df = conform_mints(base.withColumnRenamed(c, "block_time"))
            assert df.schema["block_time"].dataType.typeName() == "timestamp_ntz"
            assert df.first().block_time == datetime(2024, 1, 1), c
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
