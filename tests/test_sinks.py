import glob
import os
import tempfile

import pyarrow.parquet as pq
import pytest

from ledgerlens.plans.records import token_metrics
from ledgerlens.sources.sinks import append_metrics, ensure_metrics_table
from ledgerlens.sources.tables import derive_from_tpch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def metrics(spark):
    """The records, written once: the tests are about the sink."""
    path = tempfile.mkdtemp(prefix="ll-records-") + "/records"
    token_metrics(derive_from_tpch(spark, SF)).write.parquet(path)
    return spark.read.parquet(path)


def folder():
    return tempfile.mkdtemp(prefix="ll-sink-")


def ranges(pattern):
    """(least, greatest key) of each file, from the footers."""
    out = []
    for f in glob.glob(pattern):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index("token_address")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return sorted(out)


def rows_scanned(df):
    """Rows that the scan of a frame read when the frame was collected."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def rows_of_file(pattern, token):
    """Rows of the one file that holds a token."""
    tables = [pq.read_table(f, columns=["token_address"]).column(0).to_pylist() for f in glob.glob(pattern)]
    own, = [t for t in tables if token in t]
    return len(own)


def test_append_and_read_back(spark, metrics):
    d = folder()
    n = append_metrics(metrics, path=f"{d}/metrics")
    back = spark.read.parquet(f"{d}/metrics")
    assert n == back.count() == metrics.count()
    assert sorted(back.collect()) == sorted(metrics.collect())
    append_metrics(metrics, path=f"{d}/metrics")
    assert spark.read.parquet(f"{d}/metrics").count() == 2 * n


def test_empty_append_writes_nothing(spark, metrics):
    d = folder()
    assert append_metrics(metrics.limit(0), path=f"{d}/metrics") == 0
    assert not os.path.exists(f"{d}/metrics")


def test_files_hold_disjoint_sorted_ranges(spark, metrics):
    d = folder()
    append_metrics(metrics, path=f"{d}/metrics", files=5)
    found = ranges(f"{d}/metrics/*.parquet")
    assert len(found) == 5 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    for f in glob.glob(f"{d}/metrics/*.parquet"):
        keys = pq.read_table(f, columns=["token_address"]).column(0).to_pylist()
        assert keys == sorted(keys)


def test_create_table_if_absent(spark, metrics):
    d = tempfile.mkdtemp(prefix="ll-tbl-")
    ensure_metrics_table(spark, "ll_token_metrics_t", location=f"{d}/t")
    ensure_metrics_table(spark, "ll_token_metrics_t", location=f"{d}/t")
    n = append_metrics(metrics, table="ll_token_metrics_t")
    assert spark.table("ll_token_metrics_t").count() == n
    with pytest.raises(ValueError, match="not partitioned"):
        append_metrics(metrics, table="ll_token_metrics_t", run_id="a")
    spark.sql("DROP TABLE ll_token_metrics_t")


def test_point_read_of_the_clustered_table_opens_one_file(spark, metrics):
    d = tempfile.mkdtemp(prefix="ll-tbl-")
    ensure_metrics_table(spark, "ll_clustered", location=f"{d}/t", buckets=8)
    append_metrics(metrics, table="ll_clustered")
    assert len(glob.glob(f"{d}/t/*.parquet")) == 8
    token = metrics.first().token_address
    point = spark.table("ll_clustered").where(f"token_address = '{token}'")
    assert point.collect() == metrics.where(f"token_address = '{token}'").collect()
    assert rows_scanned(point) == rows_of_file(f"{d}/t/*.parquet", token) < metrics.count() / 4
    grouped = spark.table("ll_clustered").groupBy("token_address").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE ll_clustered")


def test_a_repeated_run_replaces_its_own_rows(spark, metrics):
    d = folder()
    n = append_metrics(metrics, path=f"{d}/m", run_id="day 1", files=3)
    assert append_metrics(metrics.limit(50), path=f"{d}/m", run_id="day/2") == 50
    assert append_metrics(metrics, path=f"{d}/m", run_id="day 1", files=2) == n
    back = spark.read.parquet(f"{d}/m")
    assert {r.run_id: r["count"] for r in back.groupBy("run_id").count().collect()} == {"day 1": n, "day/2": 50}
    assert sorted(back.where("run_id = 'day 1'").drop("run_id").collect()) == sorted(metrics.collect())
    found = ranges(f"{d}/m/run_id=day 1/*.parquet")
    assert len(found) == 2 and found[0][1] < found[1][0]
    assert append_metrics(metrics.limit(0), path=f"{d}/m", run_id="day 1") == 0
    assert spark.read.parquet(f"{d}/m").where("run_id = 'day 1'").count() == n
    with pytest.raises(ValueError):
        append_metrics(metrics, path=f"{d}/m", run_id="")


def test_a_run_that_fails_leaves_the_earlier_one(spark, metrics):
    from pyspark.sql import functions as F

    d = folder()
    n = append_metrics(metrics, path=f"{d}/m", run_id="a")
    broken = metrics.withColumn("source", F.when(F.col("token_address") > "T00000100", F.raise_error(F.lit("lost"))).otherwise(F.col("source")))
    with pytest.raises(Exception, match="lost"):
        append_metrics(broken, path=f"{d}/m", run_id="a")
    assert spark.read.parquet(f"{d}/m").count() == n


def test_runs_of_a_clustered_table(spark, metrics):
    d = tempfile.mkdtemp(prefix="ll-tbl-")
    ensure_metrics_table(spark, "ll_runs", location=f"{d}/t", buckets=4, by_run=True)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    n = append_metrics(metrics, table="ll_runs", run_id="a")
    append_metrics(metrics.limit(7), table="ll_runs", run_id="b")
    assert append_metrics(metrics, table="ll_runs", run_id="a") == n
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    counts = {r.run_id: r["count"] for r in spark.table("ll_runs").groupBy("run_id").count().collect()}
    assert counts == {"a": n, "b": 7}
    token = metrics.first().token_address
    point = spark.table("ll_runs").where(f"run_id = 'a' and token_address = '{token}'")
    assert point.drop("run_id").collect() == metrics.where(f"token_address = '{token}'").collect()
    assert rows_scanned(point) == rows_of_file(f"{d}/t/run_id=a/*.parquet", token) < n / 2
    with pytest.raises(ValueError, match="run_id"):
        append_metrics(metrics, table="ll_runs")
    spark.sql("DROP TABLE ll_runs")
