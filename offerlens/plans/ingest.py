"""Offer batch ingest: gates, repost fold, scores, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.operators.gates import gate_offers
from offerlens.operators.reposts import fold_reposts


def ingest_outcomes(offers: DataFrame, companies: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One outcome per arriving offer: a gate's reason, updated, inserted or
    repost_duplicate (with its canonical offer).

    ``offers``: offer_id (arrival order), provider, provider_offer_id,
    provider_url, company_id, title, description, seen_at. A later row of the
    same (provider, provider_offer_id) in the batch updates the first one.
    ``existing`` holds the stored offers in the layout the fold expects plus
    the two provider columns.
    """
    gated = gate_offers(offers, companies)
    passed = gated.filter("outcome IS NULL").drop("outcome", "resolution")
    key = ["provider", "provider_offer_id"]
    first = passed.groupBy(*key).agg(F.min("offer_id").alias("offer_id"))
    if existing is not None:
        first = first.join(existing.select(*key), key, "left_anti")
    fresh = passed.join(first.select("offer_id"), "offer_id", "left_semi")
    updated = passed.join(first.select("offer_id"), "offer_id", "left_anti")
    folded = fold_reposts(fresh, existing)
    none = F.lit(None).cast("long")
    parts = [
        gated.filter("outcome IS NOT NULL").select("offer_id", "company_id", "outcome", none.alias("canonical_id")),
        updated.select("offer_id", "company_id", F.lit("updated").alias("outcome"), none.alias("canonical_id")),
        folded.select("offer_id", "company_id", F.when(F.col("is_repost"), "repost_duplicate")
                      .otherwise("inserted").alias("outcome"), "canonical_id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ingest_counters(outcomes: DataFrame) -> DataFrame:
    o = F.col("outcome")
    gates = ("missing_provider_url", "missing_description", "company_unidentifiable", "company_resolved")
    touched = o.isin("inserted", "updated", "repost_duplicate", "company_resolved")
    return outcomes.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(o.isin("inserted", "updated")).alias("upserted"),
        F.count_if(o == "repost_duplicate").alias("duplicates"),
        F.count_if(o.isin(*gates)).alias("skipped"),
        F.count_if(o == "missing_description").alias("missing_description"),
        F.max(touched.cast("long")).alias("affected"),
    ).agg(*[F.sum(c).alias(c) for c in (
        "processed", "upserted", "duplicates", "skipped", "missing_description", "affected")])
