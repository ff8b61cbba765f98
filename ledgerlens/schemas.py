"""Schemas of the inputs and of the per-token record."""

from pyspark.sql.types import (DecimalType, DoubleType, StringType, StructField, StructType,
                               TimestampNTZType)

AMOUNT = DecimalType(20, 0)

MINTS = StructType([StructField("mint", StringType()), StructField("amount", AMOUNT),
                    StructField("block_time", TimestampNTZType())])
BURNS = StructType([StructField("mint", StringType()), StructField("amount", AMOUNT),
                    StructField("block_time", TimestampNTZType())])
SWAPS = StructType([
    StructField("source", StringType()), StructField("base_coin", StringType()),
    StructField("quote_coin", StringType()), StructField("base_coin_amount", AMOUNT),
    StructField("quote_coin_amount", AMOUNT), StructField("base_pool_balance_after", AMOUNT),
    StructField("quote_pool_balance_after", AMOUNT), StructField("block_time", TimestampNTZType()),
])

TOKEN_METRICS = StructType([
    StructField("token_address", StringType(), False),
    StructField("blockchain", StringType(), False),
    StructField("symbol", StringType()),
    StructField("price_usd", DoubleType(), False),
    StructField("market_cap_usd", DoubleType(), False),
    StructField("supply", DoubleType(), False),
    StructField("burned", DoubleType(), False),
    StructField("largest_lp_pool_usd", DoubleType(), False),
    StructField("first_tx_date", TimestampNTZType(), False),
    StructField("source", StringType(), False),
    StructField("name", StringType()),
    StructField("uri", StringType()),
])

TOKEN_METRICS_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TOKEN_METRICS.fields)
