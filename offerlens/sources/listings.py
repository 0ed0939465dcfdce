"""Listing sources: caps per tenant, paged listings, hydration, date buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_tenant(jobs: DataFrame, cap: int | None = None) -> DataFrame:
    """The first ``cap`` jobs per tenant by id (by default all), then the incomplete ones go.

    The rank limit is applied before the shuffle, so a hot tenant sends at
    most ``cap`` rows per task.
    """
    if cap is not None:
        rank = F.row_number().over(Window.partitionBy("tenant").orderBy("id"))
        jobs = jobs.withColumn("rn", rank).filter(F.col("rn") <= cap).drop("rn")
    return jobs.filter(
        "id IS NOT NULL AND coalesce(title, '') <> '' AND coalesce(url, '') <> ''")


def paged_listing(
    rows: DataFrame, max_pages: int | None = None, max_offers: int | None = None
) -> DataFrame:
    """Rows (listing, page_no from 0, pos, offer_id, ...) a paged read returns.

    Pages are read in order up to the first one that is missing, and, if caps
    are given, up to the page cap and until the accepted rows reach the offer
    cap. A row with a null offer_id fills its page but is not accepted. Only
    page counts enter the running sums.
    """
    counts = rows.groupBy("listing", "page_no").agg(F.count("offer_id").alias("n"))
    pages = Window.partitionBy("listing").orderBy("page_no")
    before = F.coalesce(F.sum("n").over(pages.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    # without a gap the k-th page that has rows is page k
    opened = counts.select("listing", "page_no", before.alias("before"), F.row_number().over(pages).alias("k")).filter(
        F.col("page_no") == F.col("k") - 1).drop("k")
    if max_pages is not None:
        opened = opened.filter(F.col("page_no") < max_pages)
    if max_offers is not None:
        opened = opened.filter(F.col("before") < max_offers)
    read = rows.filter("offer_id IS NOT NULL").join(opened, ["listing", "page_no"])
    if max_offers is not None:
        in_page = F.row_number().over(Window.partitionBy("listing", "page_no").orderBy("pos"))
        read = read.withColumn("rn", in_page).filter(F.col("before") + F.col("rn") <= max_offers).drop("rn")
    return read.drop("before")


def listing_counters(rows: DataFrame, max_pages: int | None = None, max_offers: int | None = None) -> DataFrame:
    """Per listing: pages and offers read, and what cut it short (maxPages, maxOffers or null)."""
    read = paged_listing(rows, max_pages, max_offers).groupBy("listing").agg(
        F.count_distinct("page_no").alias("pages"), F.count(F.lit(1)).alias("offers"))
    whole = paged_listing(rows).groupBy("listing").agg(
        F.count(F.lit(1)).alias("all_offers"), (F.max("page_no") + 1).alias("all_pages"))
    cut = F.when(F.coalesce("offers", F.lit(0)) < F.col("all_offers"),
                 F.when(F.lit(max_offers).isNotNull() & (F.col("offers") >= F.lit(max_offers)), "maxOffers").otherwise("maxPages"))
    zero = F.lit(0).cast("long")
    return whole.join(read, "listing", "left").select(
        "listing", F.coalesce("pages", zero).alias("pages"), F.coalesce("offers", zero).alias("offers"), cut.alias("truncated_by"))


def hydrate(requested: DataFrame, payload: DataFrame) -> DataFrame:
    """Requested (tenant, id) with details; the last payload row of an id wins."""
    rest = [c for c in payload.columns if c not in ("tenant", "id")]
    last = payload.groupBy("tenant", "id").agg(F.max_by(F.struct(*rest), "pos").alias("d"))
    return requested.join(last, ["tenant", "id"]).select(requested["*"], "d.*")


def hydration_counters(requested: DataFrame, payload: DataFrame) -> DataFrame:
    """tenant, requested, missed: requests whose id the tenant's payload does not hold."""
    there = payload.select("tenant", "id").distinct().withColumn("there", F.lit(True))
    return requested.join(there, ["tenant", "id"], "left").groupBy("tenant").agg(
        F.count(F.lit(1)).alias("requested"), F.count_if(F.col("there").isNull()).alias("missed"))


def since_bucket(updated: Column, now: Column) -> Column:
    days = (F.unix_micros(now) - F.unix_micros(updated)) / F.lit(86_400_000_000)
    return (
        F.when(days <= 1, "_24_HOURS").when(days <= 7, "_7_DAYS").when(days <= 15, "_15_DAYS")
        .when(days.isNotNull(), "ANY"))
