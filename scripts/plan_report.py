"""Physical-plan summary of every registered query as it would run on large
tables: derived inputs written once as Parquet and read back with clean keys,
broadcast joins disabled, AQE off (the static plan).  Prints a Markdown table.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.plans import registry  # noqa: E402
from ledgerlens.session import local_session  # noqa: E402
from ledgerlens.sources.tables import derive_from_tpch, read_tables, write_tables  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.enabled": "false"})
    d = tempfile.mkdtemp(prefix="ll-plans-")
    write_tables(derive_from_tpch(spark, sf_dir), d)
    clean = read_tables(spark, d, normalize_keys=False)
    registry._tables = lambda spark, sf_dir: clean   # every query over the clean tables
    print("| query | scans | shuffles | sort-merge joins | map-side reduction | sort aggregate |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(registry.QUERIES.items()):
        p = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = p.splitlines()
        scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet\]", p)
        shuffles = sum(1 for ln in lines if "Exchange hashpartitioning" in ln and "Reused" not in ln)
        smj = p.count("SortMergeJoin")
        partial = sorted({m for m in re.findall(r"partial_(\w+)\(", p)}
                         | ({"WindowGroupLimit"} if "WindowGroupLimit" in p else set()))
        sort_agg = "yes" if "SortAggregate" in p else ""
        print(f"| {name} | {', '.join(sorted(scans))} | {shuffles} | {smj} | "
              f"{', '.join(partial)} | {sort_agg} |")
    spark.stop()


if __name__ == "__main__":
    main()
