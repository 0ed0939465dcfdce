"""Ingest gates as one tagged outcome per offer; nothing is dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.constants import ATS_PROVIDERS, RESOLVED
from offerlens.functions.text import blank_to_null
from offerlens.functions.urls import is_absolute_url, normalize_company_name, website_domain


def identity(name: Column, website: Column) -> Column:
    """struct(domain, name): the keys a company is known by."""
    return F.struct(
        website_domain(website).alias("domain"),
        F.nullif(normalize_company_name(name), F.lit("")).alias("name"))


def gate_outcome(company_id: Column | None = None, resolution: Column | None = None) -> Column:
    """First gate that rejects the offer, else null. Reads provider_url, provider and
    description; company_id and resolution (of the company table) unless given."""
    company_id = F.col("company_id") if company_id is None else company_id
    resolution = F.col("resolution") if resolution is None else resolution
    return (
        F.when(~is_absolute_url(F.col("provider_url")), "missing_provider_url")
        .when(F.col("provider").isin(*ATS_PROVIDERS) & blank_to_null(F.col("description")).isNull(),
              "missing_description")
        .when(company_id.isNull(), "company_unidentifiable")
        .when(resolution.isin(*RESOLVED), "company_resolved"))


def gate_offers(offers: DataFrame, companies: DataFrame) -> DataFrame:
    known = companies.select(F.col("id").alias("company_id"), "resolution")
    return offers.join(known, "company_id", "left").withColumn("outcome", gate_outcome())


def seen_at(updated: Column, published: Column, as_of: Column) -> Column:
    return F.coalesce(F.nullif(updated, F.lit("")), F.nullif(published, F.lit("")), as_of)
