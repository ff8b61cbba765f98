import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_end_to_end(spark):
    from ledgerlens.sources.tables import derive_from_tpch, write_tables
    d = tempfile.mkdtemp(prefix="ll-cli-")
    write_tables(derive_from_tpch(spark, "/root/testdata/sf0.001"), f"{d}/in")
    env = dict(os.environ, PYTHONPATH=ROOT,
               PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false pyspark-shell")
    cmd = [sys.executable, "-m", "ledgerlens", "--tables", f"{d}/in", "--out", f"{d}/out",
           "--enriched", "--clean-keys"]
    res = subprocess.run(cmd, env=env, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    summary = json.loads(res.stdout.strip().splitlines()[-1])
    assert summary["records"] == spark.read.parquet(f"{d}/out").count() > 0
    assert 0 < summary["records_with_symbol"] <= summary["records"]


def test_cli_counts_and_writes_in_one_pass(spark):
    """The event log has one execution that reads the tables; counts equal the run summary; a repeated run replaces its rows."""
    from ledgerlens.plans.records import run_summary
    from ledgerlens.sources.tables import derive_from_tpch, read_tables, write_tables
    d = tempfile.mkdtemp(prefix="ll-cli-")
    write_tables(derive_from_tpch(spark, "/root/testdata/sf0.001"), f"{d}/in")
    os.mkdir(f"{d}/log")
    env = dict(os.environ, PYTHONPATH=ROOT,
               PYSPARK_SUBMIT_ARGS=f"--master local[2] --conf spark.ui.enabled=false --conf spark.eventLog.enabled=true --conf spark.eventLog.compress=false "
                                   f"--conf spark.eventLog.dir=file://{d}/log pyspark-shell")
    cmd = [sys.executable, "-m", "ledgerlens", "--tables", f"{d}/in", "--out", f"{d}/out", "--enriched", "--clean-keys", "--run-id", "r1"]
    for _ in range(2):
        res = subprocess.run(cmd, env=env, capture_output=True, text=True, timeout=600)
        assert res.returncode == 0, res.stderr[-2000:]
    summary = json.loads(res.stdout.strip().splitlines()[-1])
    want = run_summary(read_tables(spark, f"{d}/in", normalize_keys=False)).first()
    back = spark.read.parquet(f"{d}/out")
    assert summary["records"] == want.records == back.count() and {r.run_id for r in back.select("run_id").distinct().collect()} == {"r1"}
    assert summary["records_with_symbol"] == back.where("symbol is not null").count() <= want.tokens_with_symbol
    for root, _, files in os.walk(f"{d}/log"):
        events = [json.loads(line) for f in files if f.startswith("events") for line in open(os.path.join(root, f))]
        runs = [e for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart") and "Scan parquet" in e["physicalPlanDescription"]]
        assert len(runs) == (1 if events else 0), [e["description"] for e in runs]


def test_cli_dry_run_shows_records(spark):
    from ledgerlens.sources.tables import derive_from_tpch, write_tables
    d = tempfile.mkdtemp(prefix="ll-cli-")
    write_tables(derive_from_tpch(spark, "/root/testdata/sf0.001"), f"{d}/in")
    env = dict(os.environ, PYTHONPATH=ROOT,
               PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false pyspark-shell")
    cmd = [sys.executable, "-m", "ledgerlens", "--tables", f"{d}/in", "--show", "3", "--limit", "100"]
    res = subprocess.run(cmd, env=env, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    summary = json.loads(res.stdout.strip().splitlines()[-1])
    assert 0 < summary["records"] <= 100
    assert "token_address" in res.stdout and not os.path.exists(f"{d}/out")
