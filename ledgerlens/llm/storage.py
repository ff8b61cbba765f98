"""Tables written between the steps of an operator.

Every operator cuts its lineage by writing a table into the folder that
``spark.checkpoint.dir`` names, which all executors share; a lost executor then
costs one step, not the whole job.  Only where that setting is absent and the
master is local (tests, notebooks) is a folder of this machine used.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; raises on a cluster that does not name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="ledgerlens-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ledgerlens-{name}-{uuid.uuid4().hex}"


PART_ROWS = 200_000  # of a small table's file


def save(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), most_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    ``most_rows``: a bound of its rows, if they are narrow.  Files of ``PART_ROWS`` are enough then; the driver
    remembers every task, and every file of a table it has read, long after the table is gone.
    """
    spark = df.sparkSession
    if most_rows is not None:
        df = df.coalesce(1 + most_rows // PART_ROWS)
    path = new_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete paths of a finished step (through Hadoop's file system, so any scheme works)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def remove_table(df: DataFrame) -> None:
    """Delete the folder behind a table made by :func:`save`."""
    files = df.inputFiles()
    if files:
        remove(df.sparkSession, files[0].rsplit("/", 1)[0])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package where neither their path nor their folder has it.

    On a cluster the package is installed or given by ``--py-files``; a notebook or a
    script that only changed ``sys.path`` gets it sent from here.
    """
    package = Path(__file__).resolve().parents[1]
    known = [Path.cwd(), *(Path(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or any(p.resolve() == package.parent for p in known):
        return
    file = Path(tempfile.mkdtemp(prefix="ledgerlens-")) / f"{package.name}.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(file))
    _SHIPPED.add(app)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer referenced.

    It does so when the driver collects garbage, which an idle driver may not do for long;
    what Python gives up in one round only the next one finds.
    """
    for _ in range(3):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
