"""The per-token record pipeline.

One lazy plan:

    mints  -> SUM(amount), MIN(block_time) per valid key   (the token set itself)
           -> left join decimals (preset, resolved, 6)
    burns  -> SUM(amount) per key                           } partial aggregates,
    swaps  -> MIN(block_time) per side key                  } joined on the token key
    swaps  -> pool sides -> best pool / reserves per token  }
    [metadata] -> left join
    -> supply, burned, circulating, market cap, 12 columns, undated tokens dropped

The token set comes out of the same aggregate as minted and first-mint
(stages 1, 4 and 6 of the reference in one pass).  The pool branch needs the
token map and the anchors' rows too; Catalyst prunes those copies to key-only
aggregates (the second of three keys), so a lazy plan reads the key column of
``mints`` again for each.  A caller that owns the run can pass ``persist_tokens=True`` (one row
per token, memory and disk) so all branches read one aggregation, and
unpersist ``parts.tokens`` afterwards, as the batch entry point does.  Every
per-token input is hash partitioned on the token key, so the final joins need
no further exchange (or become broadcasts under AQE when small).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BLOCKCHAIN, TOKEN_METRICS_COLUMNS
from ..functions.keys import is_valid_key
from ..functions.numeric import scale_down_exact
from ..operators.discovery import MAX_PUSHED_TOKENS, first_tokens, only_tokens
from ..operators.lifetimes import first_swaps
from ..operators.pools import pool_sides, pool_summary_by_token
from ..operators.supply import RAW, burned_by_token, resolved_decimals, supply_columns
from ..sources.enrichment import (account_metadata, decimals_from_batches, decimals_from_responses, metadata_from_batches,
                                  metadata_per_token)
from ..sources.tables import TokenTables


@dataclass(frozen=True)
class PipelineParts:
    """Intermediate frames of one pipeline run (for reuse and tests)."""

    tokens: DataFrame        # mint, minted_raw, first_mint, decimals
    sides: DataFrame         # candidate pool sides (see operators.pools.pool_sides)
    records: DataFrame       # all tokens, before dropping undated ones


def token_base(mints: DataFrame, limit: int | None = None) -> DataFrame:
    """Token set plus minted and first-mint, from one aggregate of ``mints``."""
    base = (mints.where(is_valid_key("mint")).groupBy("mint")
            .agg(F.sum("amount").cast(RAW).alias("minted_raw"),
                 F.min("block_time").alias("first_mint")))
    if limit is not None:
        base = base.orderBy("mint").limit(int(limit))
    return base


def build(tables: TokenTables, *, decimals: DataFrame | None = None,
          metadata: DataFrame | None = None, sol_price: float | None = None,
          limit: int | None = None, persist_tokens: bool = False) -> PipelineParts:
    tokens = resolved_decimals(token_base(tables.mints, limit), decimals)
    if persist_tokens:
        tokens = tokens.persist(StorageLevel.MEMORY_AND_DISK)
    sides = pool_sides(tables.swaps, tokens.select("mint", "decimals"), sol_price)

    rec = (tokens
           .join(burned_by_token(tables.burns), "mint", "left")
           .join(first_swaps(tables.swaps), "mint", "left")
           .join(pool_summary_by_token(sides).drop("token_decimals"), "mint", "left"))
    if metadata is not None:
        rec = rec.join(metadata_per_token(metadata), "mint", "left")
    else:
        rec = rec.select("*", *[F.lit(None).cast("string").alias(c) for c in ("symbol", "name", "uri")])

    supply = supply_columns(F.col("minted_raw"), F.col("burned_raw"), F.col("decimals"))
    price = F.coalesce("price_usd", F.lit(0.0))
    circulating = F.greatest(F.lit(0.0), F.col("supply") - F.coalesce("reserves", F.lit(0.0)))
    rec = rec.select(
        F.col("mint").alias("token_address"),
        F.lit(BLOCKCHAIN).alias("blockchain"),
        "symbol",
        price.alias("price_usd"),
        supply.alias("supply"),
        F.coalesce("reserves", F.lit(0.0)).alias("reserves"),
        scale_down_exact(F.coalesce("burned_raw", F.lit(0)), "decimals").alias("burned"),
        F.coalesce("liquidity_usd", F.lit(0.0)).alias("largest_lp_pool_usd"),
        F.least("first_mint", "first_swap").alias("first_tx_date"),
        F.coalesce("source", F.lit("")).alias("source"),
        "name", "uri")
    rec = rec.select("*", (F.col("price_usd") * circulating).alias("market_cap_usd"))
    return PipelineParts(tokens=tokens, sides=sides, records=rec)


def limited(tables: TokenTables, limit: int | None) -> tuple[TokenTables, int | None]:
    """The tables of a run over the first ``limit`` tokens, and the limit that is still to
    be applied.  The keys are looked up first (one small job) and pushed into the scans;
    a limit beyond ``MAX_PUSHED_TOKENS`` is applied to the token aggregate instead."""
    if limit is None or not 0 <= limit <= MAX_PUSHED_TOKENS:
        return tables, limit
    return only_tokens(tables, first_tokens(tables.mints, limit)), None


def records_of(parts: PipelineParts) -> DataFrame:
    """The 12 record columns; tokens without a first transaction dropped."""
    return (parts.records.where(F.col("first_tx_date").isNotNull())
            .select(*TOKEN_METRICS_COLUMNS))


def token_metrics(tables: TokenTables, *, decimals: DataFrame | None = None,
                  metadata: DataFrame | None = None, sol_price: float | None = None,
                  limit: int | None = None) -> DataFrame:
    """The 12-column record per token (flagship).  ``decimals`` defaults to
    ``tables.token_decimals``; ``limit`` keeps the first n tokens by key and reads no
    other token's events past the scan (see :func:`limited`)."""
    tables, limit = limited(tables, limit)
    if decimals is None:
        decimals = tables.token_decimals
    return records_of(build(tables, decimals=decimals, metadata=metadata, sol_price=sol_price,
                            limit=limit))


def enrichment_inputs(tables: TokenTables) -> tuple[DataFrame, DataFrame]:
    """(decimals, metadata) from the captured replies and account blobs, one per mint or
    else in batches."""
    if tables.decimals_responses is not None:
        dec = decimals_from_responses(tables.decimals_responses)
    else:
        dec = decimals_from_batches(tables.decimals_requests, tables.decimals_batches)
    if tables.metadata_accounts is not None:
        return dec, account_metadata(tables.metadata_accounts)
    return dec, metadata_from_batches(tables.metadata_requests, tables.metadata_batches)


def token_metrics_enriched(tables: TokenTables, *, sol_price: float | None = None,
                           limit: int | None = None) -> DataFrame:
    """The full run: decimals parsed from captured RPC replies, metadata
    decoded from captured account blobs."""
    tables, limit = limited(tables, limit)
    dec, meta = enrichment_inputs(tables)
    return token_metrics(tables, decimals=dec, metadata=meta, sol_price=sol_price, limit=limit)


def run_summary(tables: TokenTables, *, sol_price: float | None = None,
                limit: int | None = None) -> DataFrame:
    """One row: tokens found, tokens with a symbol, records produced."""
    tables, limit = limited(tables, limit)
    dec, meta = enrichment_inputs(tables)
    rec = build(tables, decimals=dec, metadata=meta, sol_price=sol_price, limit=limit).records
    return rec.agg(F.count(F.lit(1)).alias("tokens_found"),
                   F.count("symbol").alias("tokens_with_symbol"),
                   F.count("first_tx_date").alias("records"))
