"""Benchmark the headline queries on the path a user runs.

The token relations are derived once from ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and written, uncleaned, as multi-file Parquet; every timed
query reads those files through ``read_tables`` on ``local[$BENCH_CPUS]``.  Each
query is executed into Spark's ``noop`` sink (full plan, nothing collected to the
driver): one warm-up run, then the median of ``$BENCH_REPEAT`` (default 3) runs.
``BENCH_ALL=1`` times every registered token query instead of the headline set.
Prints one JSON line, with the flagship's counts of file scans, shuffles and
broadcasts in the adaptive plan that ran.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import registry  # noqa: E402
from ledgerlens.plans.registry import QUERIES  # noqa: E402
from ledgerlens.session import local_session, new_folder  # noqa: E402
from ledgerlens.sources.tables import read_tables, write_raw  # noqa: E402

HEADLINE = (
    "token_metrics",
    "token_metrics_enriched",
    "token_supply",
    "first_tx_dates",
    "best_pool_metrics",
    "token_reserves",
    "latest_price_in_sol",
    "recent_swaps",
    "recent_trade_price",
    "account_metadata",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def plan_counts(spark, name: str, sf_dir: str) -> dict:
    """File scans, shuffles and broadcasts of the plan that ran (the frame's own execution, one row per token collected)."""
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    return {"file_scans": sum("FileScan" in ln for ln in lines),
            "shuffles": sum("Exchange hashpartitioning" in ln and "Reused" not in ln for ln in lines),
            "broadcasts": sum("BroadcastExchange" in ln and "Reused" not in ln for ln in lines)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    default = sorted(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    names = [n for n in (sys.argv[1:] or default) if n in QUERIES]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="ledgerlens-bench")
    root = new_folder(spark, "bench")
    write_raw(spark, sf_dir, root)
    registry._tables = lambda spark, sf_dir: read_tables(spark, root)
    times = {}
    for name in names:
        run_once(spark, name, sf_dir)
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "flagship_plan": plan_counts(spark, "token_metrics", sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
