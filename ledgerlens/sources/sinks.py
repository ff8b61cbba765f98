"""Sink for the per-token metrics: an ordered table, appended to run by run (K1, K2, O3)."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import TOKEN_METRICS_COLUMNS
from ..schemas import TOKEN_METRICS_DDL

log = logging.getLogger(__name__)

KEY = "token_address"
RUN = "run_id"


def ensure_metrics_table(spark: SparkSession, table: str, location: str | None = None, *, buckets: int | None = 16,
                         by_run: bool = False) -> None:
    """CREATE TABLE IF NOT EXISTS with the 12-column record shape, laid out by token.

    ``buckets``: the table is clustered by the token into so many buckets and sorted in each,
    so a point read opens one file of a run and joins on the token need no shuffle; None
    leaves the layout open.  ``by_run``: rows are partitioned by the ``run_id`` that
    :func:`append_metrics` is given."""
    columns, parts = TOKEN_METRICS_DDL, ""
    if by_run:
        columns, parts = f"{columns}, {RUN} string", f" PARTITIONED BY ({RUN})"
    if buckets:
        parts += f" CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {int(buckets)} BUCKETS"
    if location:
        parts += " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{parts}")


def _table_layout(spark: SparkSession, table: str) -> tuple[int | None, bool]:
    """(buckets, whether by run) of a catalog table."""
    buckets, by_run = None, RUN in spark.table(table).columns
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r.col_name == "Num Buckets" and re.fullmatch(r"\d+", r.data_type or ""):
            buckets = int(r.data_type)
    return buckets or None, by_run


def ordered(df: DataFrame, buckets: int | None = None, files: int | None = None, by: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Rows in token order: as ranges, one per task, that do not overlap (``files`` of them,
    or as many as the session's shuffle partitions give), or, for a clustered table, as the
    table's own buckets, so a bucket is one file."""
    if buckets:
        return df.repartition(buckets, KEY).sortWithinPartitions(*by)
    return (df.repartitionByRange(files, KEY) if files else df.repartitionByRange(KEY)).sortWithinPartitions(*by)


def append_metrics(df: DataFrame, *, path: str | None = None, table: str | None = None, rows: int | None = None,
                   run_id: str | None = None, files: int | None = None) -> int:
    """Append the 12 record columns in token order; returns the number of rows written.

    The files of a path hold disjoint ranges of ``token_address``, sorted; a clustered
    table gets one sorted file per bucket.  Empty input writes nothing and logs a warning.

    With a ``run_id`` the rows become that run's partition, and replace what it held: a
    run that is repeated after a failure, whole or half done, leaves its rows once.  Other
    runs stay as they are.  The rows are counted while they are written.

    Without one the rows are added to whatever is there; to write nothing for no rows,
    their number must be known first, so unless the caller gives ``rows`` the frame is
    persisted (memory and disk, recomputable if an executor is lost) and counted."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    out = df.select(*TOKEN_METRICS_COLUMNS)
    if run_id is not None:
        return replace_run(out, run_id, path=path, table=table, files=files)["rows"]
    if rows is None:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = out.count() if rows is None else rows
        if n == 0:
            log.warning("No data to insert into %s", path or table)
            return 0
        if path is not None:
            ordered(out, files=files).write.mode("append").parquet(path)
        else:
            buckets, by_run = _table_layout(df.sparkSession, table)
            if by_run:
                raise ValueError(f"{table} is partitioned by run: give a run_id")
            ordered(out, buckets, files).write.mode("append").insertInto(table)
        return n
    finally:
        if rows is None:
            out.unpersist()


def replace_run(df: DataFrame, run_id: str, *, path: str | None = None, table: str | None = None, files: int | None = None,
                measures: Mapping[str, Column] | None = None) -> dict[str, Any]:
    """Write a run's rows as its partition and return ``rows`` and the ``measures`` of them.

    By dynamic overwrite: only a partition that gets rows is replaced, and that when the
    job commits.  The aggregates are observed above the exchange that orders the rows (a
    range exchange reads its input twice, once for a sample), so each row counts once."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    if not run_id:
        raise ValueError("an empty run_id")
    spark, seen = df.sparkSession, Observation("written")
    out = df.select(*TOKEN_METRICS_COLUMNS, F.lit(str(run_id)).alias(RUN))
    asked = [F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in (measures or {}).items()]]
    if path is not None:
        (ordered(out, None, files, by=(RUN, KEY)).observe(seen, *asked).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path))
    else:
        buckets, by_run = _table_layout(spark, table)
        if not by_run:
            raise ValueError(f"{table} is not partitioned by {RUN}")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            ordered(out, buckets, files, by=(RUN, KEY)).observe(seen, *asked).write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(mode, before)
    if seen.get["rows"] == 0:
        log.warning("No data to insert into %s", path or table)
    return dict(seen.get)
