"""Export rows for the company sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.constants import APPEND_BATCH, DEFAULT_RESOLUTION, NO_NAME


def date_part(ts: Column) -> Column:
    return F.regexp_extract(F.coalesce(ts, F.lit("")), r"^\d{4}-\d{2}-\d{2}", 0)


def export_rows(companies: DataFrame, top_urls: DataFrame, categories: DataFrame) -> DataFrame:
    """The ten exported cells per company, missing values as empty text."""
    urls = top_urls.select(F.col("offer_id").alias("top_offer_id"), F.col("url").alias("top_url"))
    names = categories.select(F.col("id").alias("top_category_id"), F.col("name").alias("label"))
    blank = F.lit("")
    return (
        companies.join(urls, "top_offer_id", "left")
        .join(names, "top_category_id", "left")
        .select(
            F.col("id").alias("company_id"),
            F.coalesce("name_display", "normalized_name", F.lit(NO_NAME)).alias("company_name"),
            F.lit(DEFAULT_RESOLUTION).alias("resolution"),
            F.when(F.col("max_score").isNull(), blank)
            .otherwise(F.format_string("%.1f", F.col("max_score"))).alias("max_score"),
            *[F.coalesce(F.col(c).cast("string"), blank).alias(c)
              for c in ("strong_offer_count", "unique_offer_count", "offer_count")],
            F.coalesce("top_url", blank).alias("top_offer_url"),
            F.coalesce("label", blank).alias("top_category"),
            date_part(F.col("last_strong_at")).alias("last_strong_at")))


def appended(rows: DataFrame, sheet: DataFrame, batch: int = APPEND_BATCH) -> DataFrame:
    """Rows of companies the sheet lacks, with their batch number by id order.

    The running number is built from per-slice counts and a rank inside each
    id slice, so no single task sorts the whole export.
    """
    new = rows.join(sheet.select("company_id"), "company_id", "left_anti")
    new = new.withColumn("slice", F.floor(F.col("company_id") / 100_000))
    counts = new.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(
        Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("slice", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("slice").orderBy("company_id"))
    return new.withColumn("rn", rank).join(starts, "slice").withColumn(
        "batch_no", F.floor((F.col("before") + F.col("rn") - 1) / batch)).drop("slice", "rn", "before")


def metric_updates(rows: DataFrame, sheet: DataFrame) -> DataFrame:
    """The seven metric cells of companies the sheet already holds."""
    return rows.join(sheet.select("company_id", "row_index"), "company_id").select(
        "row_index", "max_score", "strong_offer_count", "unique_offer_count", "offer_count",
        "top_offer_url", "top_category", "last_strong_at")
