"""Continuous ingest: the batch jobs per micro-batch, and exact repeat suppression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from offerlens.plans.offer_batch import run_offer_batch
from offerlens.sinks.snapshots import Snapshots


def suppress_repeats(offers: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Drop exact repeats of (provider, provider_offer_id) within the watermark."""
    return offers.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(
        ["provider", "provider_offer_id"])


def run_per_batch(
    stream: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Feed every available micro-batch to the batch job, then stop. The batch
    number lets the job write each batch to a place of its own, so a batch
    repeated after a failure replaces its output."""
    return (
        stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def ingest_job(
    snapshots: Snapshots, ledger: str, provider: str, patterns: DataFrame, as_of: Callable[[], str], name: str
) -> Callable[[DataFrame, int], None]:
    """The offer batch ingest as a job for ``run_per_batch``.

    A micro-batch is committed under ``name`` and its number together with its tables. After a failure the stream
    repeats the batch under the same number: if it was committed, nothing happens; if not, no table had changed.
    ``seq`` orders the rows of one micro-batch.
    """

    def job(batch: DataFrame, number: int) -> None:
        run_offer_batch(snapshots, ledger, provider, batch, patterns, as_of, f"{name}/{number}", name)

    return job
