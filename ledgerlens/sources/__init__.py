"""Sources (event tables, captured lookups) and sinks (the metrics table)."""

from .tables import TokenTables, read_tables, write_tables, derive_from_tpch
from .enrichment import account_metadata, decimals_from_batches, decimals_from_responses, metadata_from_batches
from .sinks import ensure_metrics_table, append_metrics, replace_run

__all__ = ["TokenTables", "read_tables", "write_tables", "derive_from_tpch", "decimals_from_responses",
           "account_metadata", "decimals_from_batches", "metadata_from_batches", "ensure_metrics_table", "append_metrics", "replace_run"]
