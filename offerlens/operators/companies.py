"""Company metrics from scored offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.constants import STRONG_THRESHOLD

METRICS = (
    "max_score", "offer_count", "unique_offer_count", "strong_offer_count", "avg_strong_score",
    "top_category_id", "top_offer_id", "category_max_scores", "last_strong_at",
)


def offers_with_scores(offers: DataFrame, matches: DataFrame) -> DataFrame:
    """Offers left-joined to their match rows: score 0 and no category when unscored."""
    scores = matches.select(
        "offer_id", F.col("score").alias("match_score"), "matched_keywords_json"
    )
    return offers.join(scores, "offer_id", "left").select(
        "offer_id", "company_id",
        F.coalesce("match_score", F.lit(0.0)).alias("score"),
        F.get_json_object("matched_keywords_json", "$.topCategoryId").alias("category_id"),
        "published_at", "updated_at", "canonical_offer_id", "repost_count",
    )


def aggregate_companies(scored: DataFrame, strong: float = STRONG_THRESHOLD) -> DataFrame:
    """Per-company metrics over canonical offers.

    First per (company, category), then per company. Both steps combine on
    the map side and keep fixed-size states, so a company that owns a third
    of all offers costs one row per task, not one big group.
    """
    seen_at = F.nullif(F.coalesce("published_at", "updated_at"), F.lit(""))
    is_strong = F.col("score") >= strong
    part = (
        scored.filter(F.col("canonical_offer_id").isNull())
        .select(
            "company_id", F.nullif("category_id", F.lit("")).alias("category_key"),
            "score", "repost_count", is_strong.alias("is_strong"), seen_at.alias("seen_at"),
            F.struct(
                "score", seen_at.alias("seen_at"), (-F.col("offer_id")).alias("o"),
                "offer_id", "category_id",
            ).alias("top"),
        )
        .groupBy("company_id", "category_key")
        .agg(
            F.max("top").alias("top"),
            F.max("score").alias("category_max"),
            F.sum(F.lit(1) + F.col("repost_count")).alias("offer_count"),
            F.count(F.lit(1)).alias("unique_offer_count"),
            F.count_if("is_strong").alias("strong_offer_count"),
            F.sum(F.when(F.col("is_strong"), F.col("score"))).alias("strong_sum"),
            F.max(F.when(F.col("is_strong"), F.col("seen_at"))).alias("last_strong_at"),
        )
    )
    in_map = F.col("category_key").isNotNull() & (F.col("category_max") > 0)
    return part.groupBy("company_id").agg(
        F.max("top").alias("top"),
        F.sum("offer_count").alias("offer_count"),
        F.sum("unique_offer_count").alias("unique_offer_count"),
        F.sum("strong_offer_count").alias("strong_offer_count"),
        F.sum("strong_sum").alias("strong_sum"),
        F.max("last_strong_at").alias("last_strong_at"),
        F.sort_array(F.collect_list(F.when(in_map, F.struct("category_key", "category_max"))))
        .alias("entries"),
    ).select(
        "company_id",
        F.col("top.score").alias("max_score"),
        "offer_count", "unique_offer_count", "strong_offer_count",
        F.when(F.col("strong_offer_count") > 0, F.col("strong_sum") / F.col("strong_offer_count"))
        .alias("avg_strong_score"),
        F.col("top.category_id").alias("top_category_id"),
        F.col("top.offer_id").alias("top_offer_id"),
        F.map_from_entries("entries").alias("category_max_scores"),
        "last_strong_at",
    )


def aggregate_affected(
    scored: DataFrame, affected: DataFrame, strong: float = STRONG_THRESHOLD
) -> DataFrame:
    """Metrics for the touched companies only; a company left without a
    canonical offer gets zeros."""
    ids = affected.select("company_id").distinct()
    metrics = aggregate_companies(scored.join(ids, "company_id", "left_semi"), strong)
    zero = F.lit(0).cast("long")
    return ids.join(metrics, "company_id", "left").select(
        "company_id",
        F.coalesce("max_score", F.lit(0.0)).alias("max_score"),
        *[F.coalesce(c, zero).alias(c)
          for c in ("offer_count", "unique_offer_count", "strong_offer_count")],
        "avg_strong_score", "top_category_id", "top_offer_id",
        F.coalesce("category_max_scores", F.create_map().cast("map<string,double>"))
        .alias("category_max_scores"),
        "last_strong_at",
    )


def update_metrics(companies: DataFrame, metrics: DataFrame) -> DataFrame:
    """Write supplied metrics into the company table; others stay."""
    new = metrics.select("company_id", F.struct(*METRICS).alias("new"))
    joined = companies.join(
        new, companies["id"] == new["company_id"], "left"
    ).drop("company_id")
    keep = [c for c in companies.columns if c not in METRICS]
    values = [
        F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c)
        if c != "category_max_scores"
        else F.when(F.col("new").isNotNull(), F.to_json(f"new.{c}")).otherwise(F.col(c)).alias(c)
        for c in METRICS
    ]
    return joined.select(*keep, *values)


def metrics_without_company(companies: DataFrame, metrics: DataFrame) -> DataFrame:
    """Metric rows whose company is missing: an error for the caller."""
    return metrics.join(companies.select(F.col("id").alias("company_id")), "company_id", "left_anti")


def rank_companies(companies: DataFrame, k: int, by: str = "max_score") -> DataFrame:
    """Best companies first, unscored ones last, ties by id."""
    return companies.orderBy(F.desc_nulls_last(by), "id").limit(k)
