"""Batch entry point: read the event tables, build the per-token records,
append them to the sink, report counts.

    python -m ledgerlens --tables ROOT [--out PATH | --table NAME] [--show N]
                         [--enriched] [--limit N] [--sol-price P] [--clean-keys] [--run-id ID]

The records become the partition run_id=ID of the output; a run repeated under its id
replaces its own rows.  Without --out/--table nothing is written (a dry run): the records are
computed, counted and the first --show rows printed in token order.

Run with spark-submit on a cluster; cluster settings (shuffle partitions,
AQE) come from the submit configuration.
"""

from __future__ import annotations

import argparse
import json
import logging
import time

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from .plans.records import build, enrichment_inputs, limited, records_of
from .sources.sinks import ensure_metrics_table, replace_run
from .sources.tables import read_tables

log = logging.getLogger("ledgerlens")


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ledgerlens")
    p.add_argument("--tables", required=True, help="directory with mints, burns, swaps, lookups")
    out = p.add_mutually_exclusive_group()
    out.add_argument("--out", help="Parquet path to append to")
    out.add_argument("--table", help="catalog table to create if absent and append to")
    p.add_argument("--enriched", action="store_true",
                   help="decimals and metadata from captured replies / account blobs")
    p.add_argument("--limit", type=int, default=None, help="first N tokens by key (default: all)")
    p.add_argument("--sol-price", type=float, default=None)
    p.add_argument("--clean-keys", action="store_true", help="keys already normalised on write")
    p.add_argument("--run-id", default=None, help="name of the run; repeated, it replaces its own rows (default: the application's id)")
    p.add_argument("--show", type=int, default=0, help="print the first N records by token")
    a = p.parse_args(argv)
    if a.sol_price is not None and not a.sol_price > 0:
        p.error("--sol-price must be above 0")

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("ledgerlens").getOrCreate()
    t0 = time.time()
    tables, limit = limited(read_tables(spark, a.tables, normalize_keys=not a.clean_keys), a.limit)
    dec, meta = enrichment_inputs(tables) if a.enriched else (tables.token_decimals, None)
    # this run owns its lifecycle: keep the one-row-per-token frame so the
    # pool branch and the record share one aggregation of mints
    parts = build(tables, decimals=dec, metadata=meta, sol_price=a.sol_price, limit=limit,
                  persist_tokens=True)
    # counted on the way to wherever the records go: no second pass, no copy kept
    records, run = records_of(parts), a.run_id or spark.sparkContext.applicationId
    measures = {"records": F.count(F.lit(1)), "records_with_symbol": F.count("symbol")}
    if a.out or a.table:
        if a.table:
            ensure_metrics_table(spark, a.table, by_run=True)
        found = replace_run(records, run, path=a.out, table=a.table, measures=measures)
        if a.show:
            written = spark.read.parquet(a.out) if a.out else spark.table(a.table)
            written.where(F.col("run_id") == run).drop("run_id").orderBy("token_address").show(a.show, truncate=False)
    else:
        seen = Observation("run")
        counted = records.observe(seen, *[c.alias(name) for name, c in measures.items()])
        if a.show:  # the first rows in token order: every row passes once
            counted.sort("token_address").show(a.show, truncate=False)
        else:
            counted.write.format("noop").mode("overwrite").save()
        found = seen.get
    summary = {name: found[name] for name in measures}
    parts.tokens.unpersist()
    summary["seconds"] = round(time.time() - t0, 2)
    log.info("processed: %s", json.dumps(summary))
    print(json.dumps(summary))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
