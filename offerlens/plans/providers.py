"""Provider feeds to offer batches: search responses of a marketplace, and the tenants of applicant systems.

Feeds are folders of JSON files as the providers' services return them. The results are in the layout of ``offer_batch.ARRIVING``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.operators.company_sources import tenants
from offerlens.operators.numbering import numbered
from offerlens.plans.offer_batch import ARRIVING
from offerlens.session import materialized
from offerlens.sources import payloads
from offerlens.sources.listings import hydrate, hydration_counters, paged_listing

RESPONSE = f"currentPage int, totalPages int, offers array<struct<{payloads.MARKETPLACE_ITEM}>>, broken string"


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """file, listing (its folder), page_no from 0, offers and broken (the text of a file that is no JSON) of search responses, one a file."""
    rows = spark.read.schema(RESPONSE).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="broken", recursiveFileLookup=True)
    named = rows.withColumn("file", F.input_file_name())
    return materialized(named.select(
        "file", F.regexp_extract("file", "([^/]+)/[^/]+$", 1).alias("listing"), (F.col("currentPage") - 1).alias("page_no"), "offers", "broken"))


def _arriving(rows: DataFrame, *order: str) -> DataFrame:
    """Rows that have some of the columns of ARRIVING, with ``seq`` in the given order and nulls for the rest."""
    placed = numbered(rows, *order, name="seq").withColumn("seq", F.col("seq") - 1)
    fields = [part.split()[:2] for part in ARRIVING.replace("\n", " ").split(",")]
    return placed.select(*[(F.col(k) if k in placed.columns else F.lit(None)).cast(t).alias(k) for k, t in fields])


def marketplace_offers(responses: DataFrame, max_pages: int | None = None, max_offers: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(offers, counters): the offers of readable responses in the order of listing, page and place, and per listing files, broken
    files, and rows without an id (which are skipped)."""
    good = responses.filter("broken IS NULL AND page_no IS NOT NULL").select("listing", "page_no", F.posexplode("offers").alias("pos", "o"))
    taken = paged_listing(good.withColumn("offer_id", F.nullif(F.col("o.id"), F.lit(""))), max_pages, max_offers)
    mapped = payloads.map_marketplace_items(taken.select("listing", "page_no", "pos", "o.*"), "listing", "page_no", "pos")
    offers = _arriving(mapped.select(
        "listing", "page_no", "pos", "provider", F.col("id").alias("provider_offer_id"), F.col("url").alias("provider_url"), "title",
        F.col("company.id").alias("provider_company_id"), F.col("company.name").alias("company_name"),
        F.col("company.normalizedName").alias("normalized_name"), F.col("publishedAt").alias("published_at"), F.col("updatedAt").alias("updated_at"),
        F.col("requirementsSnippet").alias("requirements_snippet"), F.to_json("metadata").alias("metadata_json")), "listing", "page_no", "pos")
    counts = responses.groupBy("listing").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("broken").isNotNull()).alias("broken_files"),
        F.sum(F.coalesce(F.size(F.filter("offers", lambda o: F.coalesce(o.id, F.lit("")) == "")), F.lit(0))).alias("without_id"))
    return offers, counts


def tenant_offers(
    sources: DataFrame, provider: str, requested: DataFrame, payload: DataFrame, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(offers, counters) of a provider's tenants. Offers belong to the tenant's company, without a look at their own company data.

    ``requested``: tenant, request_no, id, what a tenant's listing names; ``payload``: tenant, pos and the provider's columns, the details.
    A request without details is missed and counted (per tenant: requested, missed); the order of requests is kept.
    """
    mapper = {"lever": payloads.map_postings, "greenhouse": payloads.map_jobs}[provider]
    known = tenants(sources, provider, limit)
    wanted = requested.join(known.select("tenant").distinct(), "tenant", "left_semi")
    details = payload.withColumn("id", F.col("id").cast("string"))
    full = hydrate(wanted.withColumn("id", F.col("id").cast("string")), details)
    mapped = mapper(full, "tenant", "request_no").join(known, "tenant")
    columns = {"id": "provider_offer_id", "url": "provider_url", "publishedAt": "published_at", "updatedAt": "updated_at", "company_id": "known_company_id"}
    named = mapped.select(*[F.col(k).alias(columns.get(k, k)) for k in mapped.columns])
    counts = hydration_counters(wanted.withColumn("id", F.col("id").cast("string")), details)
    return _arriving(named, "known_company_id", "tenant", "request_no"), counts
