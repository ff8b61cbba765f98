"""Handmade input rows for unit tests."""

from __future__ import annotations

from decimal import Decimal

from ledgerlens.constants import SOL, USDC, USDT  # noqa: F401
from ledgerlens.schemas import BURNS, MINTS, SWAPS
from ledgerlens.sources.tables import (TokenTables, conform_burns, conform_decimals, conform_mints,
                                       conform_swaps)
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

DEC = StructType([StructField("mint", StringType()), StructField("decimals", IntegerType())])


def D(x) -> Decimal:
    return Decimal(x)


def swap(source, base, quote, base_amt, quote_amt, base_bal, quote_bal, t):
    return (source, base, quote, D(base_amt), D(quote_amt), D(base_bal), D(quote_bal), t)


def tables(spark, mints=(), burns=(), swaps=(), decimals=()) -> TokenTables:
    return TokenTables(
        mints=conform_mints(spark.createDataFrame([(m, D(a), t) for m, a, t in mints], MINTS)),
        burns=conform_burns(spark.createDataFrame([(m, D(a), t) for m, a, t in burns], BURNS)),
        swaps=conform_swaps(spark.createDataFrame(list(swaps), SWAPS)),
        token_decimals=conform_decimals(spark.createDataFrame(list(decimals), DEC)),
    )


def tokens_df(spark, *mints):
    return spark.createDataFrame([(m,) for m in mints], "mint string")
