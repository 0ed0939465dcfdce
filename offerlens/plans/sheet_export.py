"""Company export as one plan: what a sheet's snapshot lacks is appended, the metric cells of what it holds are updated.

``rows`` are ``operators.export.export_rows``; a sheet is row_index, company_id and the cells. Cells that people fill in (name and resolution of
a listed company) stay; rows of companies that are not exported stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.constants import APPEND_BATCH, UPDATE_BATCH
from offerlens.operators.numbering import numbered

METRIC_CELLS = ("max_score", "strong_offer_count", "unique_offer_count", "offer_count", "top_offer_url", "top_category", "last_strong_at")
CELLS = ("company_name", "resolution", *METRIC_CELLS)


def sync(rows: DataFrame, sheet: DataFrame, append_batch: int = APPEND_BATCH, update_batch: int = UPDATE_BATCH) -> DataFrame:
    """row_index, company_id, cells, action (appended, updated, untouched) and batch_no of every row of the sheet afterwards.

    One full join against the snapshot. New rows follow the last one in the order of companies; batches are numbered
    from 0 for each action, untouched rows have none.
    """
    new = rows.select("company_id", F.struct(*CELLS).alias("new"))
    old = sheet.select("row_index", "company_id", F.struct(*CELLS).alias("old"))
    action = F.when(F.col("old").isNull(), "appended").when(F.col("new").isNull(), "untouched").otherwise("updated")
    joined = new.join(old, "company_id", "full_outer").withColumn("action", action)
    placed = numbered(joined, "action", "company_id")
    first = placed.groupBy("action").agg(F.min("position").alias("first"))
    last = sheet.agg(F.max("row_index")).first()[0] or 1  # the header
    size = F.when(F.col("action") == "appended", append_batch).when(F.col("action") == "updated", update_batch)
    within = F.col("position") - F.col("first")
    metric = [F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in METRIC_CELLS]
    own = [F.when(F.col("old").isNotNull(), F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in ("company_name", "resolution")]
    return placed.join(first, "action").select(
        F.coalesce("row_index", F.lit(last) + within + 1).cast("long").alias("row_index"), "company_id", *own, *metric, "action", F.floor(within / size).alias("batch_no"))


def snapshot(synced: DataFrame) -> DataFrame:
    return synced.select("row_index", "company_id", *CELLS)


def counters(synced: DataFrame) -> DataFrame:
    """companies, appended, updated, untouched, acted (appended or updated companies), skipped (companies without an action), batches."""
    a = F.col("action")
    exported = a != "untouched"
    batches = [F.coalesce(F.max(F.when(a == name, F.col("batch_no") + 1)), F.lit(0).cast("long")).alias(f"{alias}_batches") for name, alias in (("appended", "append"), ("updated", "update"))]
    counted = synced.agg(
        F.count_if(exported).alias("companies"), F.count_if(a == "appended").alias("appended"), F.count_if(a == "updated").alias("updated"),
        F.count_if(a == "untouched").alias("untouched"), F.count_distinct(F.when(exported, F.col("company_id"))).alias("acted"), *batches)
    return counted.select("companies", "appended", "updated", "untouched", "acted", (F.col("companies") - F.col("acted")).alias("skipped"), "append_batches", "update_batches")
