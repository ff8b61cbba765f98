"""End-to-end plans: the per-token record pipeline and the query registry."""

from .records import token_metrics, token_metrics_enriched, run_summary, build

__all__ = ["token_metrics", "token_metrics_enriched", "run_summary", "build"]
