"""Load the token event tables (mints, burns, swaps) and lookups.

Keys are normalised once, here (see ``functions.keys.normalize_key``), so no
later join can miss because two tables store the same key differently.  Only
the columns the operators use are selected; Catalyst prunes the Parquet scan
to them and pushes row filters written downstream into the reader.
"""

from __future__ import annotations

import logging
import weakref
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import BinaryType, IntegerType, LongType, TimestampType

from ..functions.keys import lenient_decode, normalize_key
from ..functions.numeric import valid_decimals
from . import fixtures

log = logging.getLogger(__name__)

AMOUNT = "decimal(20,0)"

MINT_COLUMNS = ("mint", "amount", "block_time")
BURN_COLUMNS = ("mint", "amount", "block_time")
COLUMNS = {"mints": MINT_COLUMNS, "burns": ("mint", "amount"), "token_decimals": ("mint", "decimals"),
           "decimals_responses": ("mint", "response_json"), "metadata_accounts": ("mint",)}
SWAP_COLUMNS = ("source", "base_coin", "quote_coin", "base_coin_amount", "quote_coin_amount",
                "base_pool_balance_after", "quote_pool_balance_after", "block_time")

COLUMNS["swaps"] = SWAP_COLUMNS
for _kind in ("decimals", "metadata"):
    COLUMNS[f"{_kind}_requests"], COLUMNS[f"{_kind}_batches"] = ("batch", "id", "mint"), ("batch", "body")


def _keys(df: DataFrame, *names: str, normalize: bool = True) -> list[Column]:
    """The key columns.  Normalised ones leave as the fields of one struct per row, so that
    a filter runs on the result: Catalyst would copy the normalisation into the filter, once
    for every mention of a key.  Plain ones stay plain, for filters to reach the Parquet reader."""
    if not normalize:
        return [F.col(n).cast("string").alias(n) for n in names]
    return [F.inline(F.array(F.struct(*[normalize_key(F.col(n), df.schema[n].dataType).alias(n) for n in names])))]


_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _time(df: DataFrame, name: str = "block_time"):
    """UTC wall-clock time without a zone, whatever the session's time zone:
    zoned timestamps and integral epoch seconds are counted from the epoch,
    zoneless values pass through."""
    kind = df.schema[name].dataType
    if isinstance(kind, (IntegerType, LongType)):
        return F.expr(f"timestampadd(SECOND, {name}, {_EPOCH})").alias(name)
    if isinstance(kind, TimestampType):
        return F.expr(f"timestampadd(MICROSECOND, unix_micros({name}), {_EPOCH})").alias(name)
    return F.col(name)


def _source(df: DataFrame, name: str = "source"):
    """Swap sources: bytes decoded leniently, NUL padding removed from both ends."""
    c = F.col(name)
    c = lenient_decode(c) if isinstance(df.schema[name].dataType, BinaryType) else c.cast("string")
    return F.trim(c, F.lit("\u0000")).alias(name)


def conform_mints(df: DataFrame, normalize: bool = True) -> DataFrame:
    keys = _keys(df, "mint", normalize=normalize)
    return df.select(*keys, F.col("amount").cast(AMOUNT).alias("amount"), _time(df))


def conform_burns(df: DataFrame, normalize: bool = True) -> DataFrame:
    keys = _keys(df, "mint", normalize=normalize)
    cols = [*keys, F.col("amount").cast(AMOUNT).alias("amount")]
    if "block_time" in df.columns:
        cols.append(_time(df))
    return df.select(*cols)


def conform_swaps(df: DataFrame, normalize: bool = True) -> DataFrame:
    keys = _keys(df, "base_coin", "quote_coin", normalize=normalize)
    return df.select(
        _source(df) if normalize else F.col("source").cast("string").alias("source"),
        *keys,
        *[F.col(c).cast(AMOUNT).alias(c) for c in SWAP_COLUMNS[3:7]],
        _time(df))


def conform_decimals(df: DataFrame, normalize: bool = True) -> DataFrame:
    keys = _keys(df, "mint", normalize=normalize)
    return df.select(*keys, valid_decimals("decimals").alias("decimals"))


def conform_keyed(df: DataFrame, *value_columns: str, normalize: bool = True) -> DataFrame:
    keys = _keys(df, "mint", normalize=normalize)
    return df.select(*keys, *value_columns)


def conform_accounts(df: DataFrame, normalize: bool = True) -> DataFrame:
    """Captured accounts: the base64 blob, or the whole reply that holds it."""
    blob = [c for c in ("account_data_b64", "response_json") if c in df.columns]
    if not blob:
        raise ValueError("metadata_accounts needs account_data_b64 or response_json")
    return conform_keyed(df, *blob, normalize=normalize)


def conform_requests(df: DataFrame, normalize: bool = True) -> DataFrame:
    """Which mint was asked for under which id of which batch."""
    keys = _keys(df, "mint", normalize=normalize)
    return df.select(F.col("batch").cast("string").alias("batch"), F.col("id").cast("bigint").alias("id"), *keys)


def conform_batches(df: DataFrame) -> DataFrame:
    """Captured bodies of batch replies."""
    return df.select(F.col("batch").cast("string").alias("batch"), F.col("body").cast("string").alias("body"))


@dataclass(frozen=True)
class TokenTables:
    """The inputs of the pipeline, keys already normalised."""

    mints: DataFrame
    burns: DataFrame
    swaps: DataFrame
    token_decimals: DataFrame | None = None
    decimals_responses: DataFrame | None = None
    metadata_accounts: DataFrame | None = None
    decimals_requests: DataFrame | None = None
    decimals_batches: DataFrame | None = None
    metadata_requests: DataFrame | None = None
    metadata_batches: DataFrame | None = None

    def with_(self, **kw) -> "TokenTables":
        return replace(self, **kw)


def read_tables(spark: SparkSession, root: str, fmt: str = "parquet",
                normalize_keys: bool = True) -> TokenTables:
    """Read ``<root>/{mints,burns,swaps}[.parquet]`` plus optional lookups
    (``token_decimals``, ``decimals_responses``, ``metadata_accounts``, and the batch
    requests and replies ``{decimals,metadata}_{requests,batches}``).

    ``normalize_keys=False`` is for tables whose keys are already clean
    (e.g. written by ``write_tables``): key filters then reach the Parquet
    reader as pushed filters instead of running on a derived expression."""

    def load(name: str, required: bool = True, told: bool = True) -> DataFrame | None:
        for candidate in (f"{root}/{name}.{fmt}", f"{root}/{name}"):
            try:
                df = spark.read.format(fmt).load(candidate)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":  # there, but unreadable: not the same as absent
                    raise
                continue
            if missing := [c for c in COLUMNS[name] if c not in df.columns]:
                raise ValueError(f"{candidate} lacks the columns {', '.join(missing)}")
            return df
        if required:
            raise FileNotFoundError(f"{name} not found under {root}")
        if told:
            log.warning("no %s under %s: its defaults apply to every token", name, root)
        return None

    dec = load("token_decimals", required=False)
    resp = load("decimals_responses", required=False)
    meta = load("metadata_accounts", required=False)
    batch = {n: load(n, required=False, told=False) for n in COLUMNS if n.endswith(("_requests", "_batches"))}
    batch = {n: None if df is None else conform_requests(df, normalize_keys) if n.endswith("_requests") else conform_batches(df)
             for n, df in batch.items()}
    return TokenTables(
        mints=conform_mints(load("mints"), normalize_keys),
        burns=conform_burns(load("burns"), normalize_keys),
        swaps=conform_swaps(load("swaps"), normalize_keys),
        token_decimals=None if dec is None else conform_decimals(dec, normalize_keys),
        decimals_responses=(None if resp is None
                            else conform_keyed(resp, "response_json", normalize=normalize_keys)),
        metadata_accounts=(None if meta is None
                           else conform_accounts(meta, normalize_keys)),
        **batch,
    )


def write_tables(tables: TokenTables, root: str, mode: str = "errorifexists") -> None:
    """Write the (normalised) relations as Parquet under ``root``: a one-time
    cleaning job whose output ``read_tables(..., normalize_keys=False)``
    reads back.  It also cuts the lineage of a derived input."""
    for name in COLUMNS:
        df = getattr(tables, name)
        if df is not None:
            df.write.mode(mode).parquet(f"{root}/{name}.parquet")


def _spread(spark: SparkSession, df: DataFrame, key: str, per_core: int = 1) -> DataFrame:
    """The driver's test tables are single-row-group files, which Spark reads
    in one task; a hash repartition right after the (pruned) read spreads the
    derivation over the cores (hash, not round-robin: round-robin sorts every
    input partition first to stay deterministic on retry).  Several parts per
    core let fast tasks make up for slow ones and a sort of a part stay in
    memory.  Only for these fixtures: real event tables (``read_tables``) come
    in many files and are read in parallel as they are."""
    try:
        n = spark.sparkContext.defaultParallelism * per_core
    except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


_DERIVED: "weakref.WeakKeyDictionary[SparkSession, dict[str, TokenTables]]" = weakref.WeakKeyDictionary()


def derive_from_tpch(spark: SparkSession, sf_dir: str) -> TokenTables:
    """Derive the token relations from ``lineitem``/``part`` (FIXTURES.md).

    The (lazy, immutable) frames are built once per session and directory;
    every execution still reads the base tables."""
    per_session = _DERIVED.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = _derive(spark, sf_dir)[0]
    return per_session[sf_dir]


def write_raw(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The derived relations, uncleaned, as the multi-file Parquet tables that ``read_tables`` reads."""
    for name, df in _derive(spark, sf_dir)[1].items():
        df.write.parquet(f"{root}/{name}.parquet")


def _derive(spark: SparkSession, sf_dir: str) -> tuple[TokenTables, dict[str, DataFrame]]:
    lineitem = _spread(spark, spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey", per_core=4)
    part = _spread(spark, spark.read.parquet(f"{sf_dir}/part.parquet"), "p_partkey")

    def q(sql: str) -> DataFrame:
        return spark.sql(sql, lineitem=lineitem, part=part)

    raw = {name: q(sql) for name, sql in {**fixtures.RELATIONS, **fixtures.SPARK_RELATIONS}.items()}
    raw = {name: soiled(df) for name, df in raw.items()}
    return TokenTables(
        mints=conform_mints(raw["mints"]), burns=conform_burns(raw["burns"]), swaps=conform_swaps(raw["swaps"]),
        token_decimals=conform_decimals(raw["token_decimals"]),
        decimals_responses=conform_keyed(raw["decimals_responses"], "response_json"),
        metadata_accounts=conform_accounts(raw["metadata_accounts"]),
        decimals_requests=conform_requests(raw["decimals_requests"]), decimals_batches=conform_batches(raw["decimals_batches"]),
        metadata_requests=conform_requests(raw["metadata_requests"]), metadata_batches=conform_batches(raw["metadata_batches"]),
    ), raw


def soiled(df: DataFrame) -> DataFrame:
    """Keys and sources as feeds deliver them: bytes, NUL-padded, with stray spaces
    and broken bytes around the clean value, which is what the oracle expects.

    The values leave as the fields of one struct per row: a filter on them then runs on
    the delivered values, as it does on files.  Written over plain columns, Catalyst would
    copy the whole derivation into the filter, once for every mention of a key."""
    pick = F.col("_pick")

    def dirty(name: str):
        raw = F.col(name).cast("binary")
        return (F.when(F.pmod(pick, F.lit(4)) == 0, F.concat(raw, F.unhex(F.lit("000000"))))
                .when(F.pmod(pick, F.lit(4)) == 1, F.concat(F.unhex(F.lit("20")), raw, F.unhex(F.lit("0A"))))
                .when(F.pmod(pick, F.lit(4)) == 2, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw).alias(name))

    def padded(name: str):
        return F.when(F.pmod(pick, F.lit(3)) == 0, F.concat(F.col(name), F.lit("\u0000\u0000"))).otherwise(F.col(name)).alias(name)

    values = [dirty(c) if c in ("mint", "base_coin", "quote_coin") else padded(c) if c == "source" else F.col(c)
              for c in df.columns]
    return df.select("*", F.xxhash64(*df.columns).alias("_pick")).select(F.inline(F.array(F.struct(*values))))
