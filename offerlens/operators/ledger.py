"""Run ledger: an opening and a closing row for each run, folded to one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = (
    "offers_fetched", "offers_upserted", "offers_duplicates", "offers_skipped", "offers_failed", "offers_skipped_missing_description",
    "offers_skipped_repost_duplicate", "affected_companies", "companies_aggregated", "companies_failed",
)
LEDGER = ("run_id string, provider string, query_key string, at string, status string, error string, "
          + ", ".join(f"{name} long" for name in COUNTERS))


def run_ledger(rows: DataFrame) -> DataFrame:
    """One row per run: started_at, finished_at and status of its closing row; ``running`` while there is none.

    Of several closing rows (a repeated write) the latest counts.
    """
    closed = F.col("status") != "running"
    last = F.max_by(F.struct("status", "error", *COUNTERS), F.when(closed, F.struct("at", "status")))
    return rows.groupBy("run_id").agg(
        F.min("provider").alias("provider"), F.min("query_key").alias("query_key"),
        F.min(F.when(~closed, F.col("at"))).alias("started_at"), F.max(F.when(closed, F.col("at"))).alias("finished_at"), last.alias("last"),
    ).select("run_id", "provider", "query_key", "started_at", "finished_at", F.coalesce("last.status", F.lit("running")).alias("status"),
             "last.error", *[f"last.{name}" for name in COUNTERS])
