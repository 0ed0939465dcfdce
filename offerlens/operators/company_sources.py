"""Links between companies and providers, metric and resolution write-backs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.constants import SHEET_HEADERS
from offerlens.functions.text import trim_space
from offerlens.operators.merges import delete_offers, last_rows, latest_values, merge_coalesce


def merge_by_provider_id(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Links with a provider id merge on (provider, id): company_id is overwritten by the latest row, each other
    column (url, hidden, raw_json, whatever ``existing`` has) by its latest non-null value. Links without an id are always added."""
    key = ["provider", "provider_company_id"]
    named = updates.filter("provider_company_id IS NOT NULL")
    rest = [c for c in existing.columns if c not in (*key, "company_id")]
    last = last_rows(named.select(*key, "seq", "company_id"), key, "seq").join(latest_values(named, key, "seq", rest), key)
    merged = merge_coalesce(existing.filter("provider_company_id IS NOT NULL"), last, key)
    unnamed = "provider_company_id IS NULL"
    return merged.unionByName(existing.filter(unnamed)).unionByName(updates.filter(unnamed).select(*existing.columns))


def merge_by_company(existing: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, refused): links merge on (company, provider), id and URL are
    overwritten, nulls included.

    A provider id that another company holds already, or that several companies
    claim at once, is refused: the link keeps its old id and URL, a new link is
    not made, and the claim is in ``refused``. Of several claims to a free id
    the smallest company's is accepted.
    """
    key = ["company_id", "provider"]
    columns = ["provider_company_id", "url"]
    last = last_rows(updates, key, "seq").select(*key, *columns)
    held = existing.filter("provider_company_id IS NOT NULL").groupBy("provider", "provider_company_id").agg(
        F.min("company_id").alias("holder"))
    claims = last.filter("provider_company_id IS NOT NULL").groupBy("provider", "provider_company_id").agg(
        F.min("company_id").alias("first_claim"))
    judged = last.join(held, ["provider", "provider_company_id"], "left").join(
        claims, ["provider", "provider_company_id"], "left").withColumn(
        "refused", F.coalesce(F.coalesce("holder", "first_claim") != F.col("company_id"), F.lit(False)))
    accepted = judged.filter("NOT refused").select(*key, F.struct(*columns).alias("new"))
    merged = existing.select(*key, F.struct(*columns).alias("old")).join(accepted, key, "full_outer").select(
        *key, F.when(F.col("new").isNotNull(), F.col("new")).otherwise(F.col("old")).alias("r")
    ).select(*key, "r.*")
    return merged, judged.filter("refused").select(*key, *columns)


def tenants(sources: DataFrame, provider: str, limit: int | None = None) -> DataFrame:
    """company_id, tenant of a provider's visible links with an id, in the order of companies; by default all."""
    rows = sources.filter((F.col("provider") == provider) & F.col("provider_company_id").isNotNull() & ~F.coalesce("hidden", F.lit(False))).select(
        "company_id", F.col("provider_company_id").alias("tenant"))
    return rows if limit is None else rows.orderBy("company_id", "tenant").limit(limit)


def apply_feedback(plan: DataFrame, companies: DataFrame, offers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies with their new resolutions, and the offers left after the
    destructive changes. Metric columns stay as they are."""
    changes = plan.filter("state = 'changed'").select(
        F.col("company_id").alias("id"), F.col("to_resolution").alias("new"), "classification")
    updated = companies.join(changes.drop("classification"), "id", "left").withColumn(
        "resolution", F.coalesce("new", "resolution")).drop("new")
    gone = changes.filter("classification = 'destructive'").select(F.col("id").alias("company_id"))
    return updated, delete_offers(offers, gone)


def header_mismatches(header: DataFrame, expected: tuple[str, ...] = SHEET_HEADERS) -> DataFrame:
    """Differing header cells of (sheet, cells array); empty when the contract holds."""
    want = F.array(*[F.lit(h) for h in expected])
    pairs = F.arrays_zip(want.alias("expected"), F.col("cells").alias("actual"))
    return header.select("sheet", F.posexplode(pairs).alias("pos", "p")).select(
        "sheet", "pos", "p.expected", trim_space(F.col("p.actual")).alias("actual")
    ).filter(~F.col("expected").eqNullSafe(F.col("actual")))
