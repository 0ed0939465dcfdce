"""Offer scores from dictionary hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.constants import (
    BUCKET_CAPS,
    BUCKET_PREFIXES,
    CORE_THRESHOLD,
    DEFAULT_BUCKET,
    MAX_SCORE,
    MIN_SCORE,
    NO_CORE_CAP,
    SYNERGY_BIZ,
    SYNERGY_INTL,
    SYNERGY_MAX,
    SYNERGY_MIN_BUCKET,
)


def bucket_of(category_id: Column) -> Column:
    out = F.lit(DEFAULT_BUCKET)
    for bucket, prefix in BUCKET_PREFIXES.items():
        out = F.when(F.startswith(category_id, F.lit(prefix)), F.lit(bucket)).otherwise(out)
    return out


def contributions(hits: DataFrame, *keys: str) -> DataFrame:
    """One row per (offer, category) and per (offer, phrase).

    ``points`` is the best non-negated hit, ``hit_count`` the number of
    non-negated hits; a group of negated hits only keeps null points.
    """
    active = ~F.col("is_negated")
    group = F.when(F.col("kind") == "keyword", F.col("category_id")).otherwise(F.col("dict_id"))
    return hits.withColumn("group_id", group).groupBy(*keys, "kind", "group_id").agg(
        F.count_if(active & F.col("points").isNotNull()).alias("hit_count"),
        F.count_if(~active).alias("negated_count"),
        F.max(F.when(active, F.col("points"))).alias("points"),
        F.min(F.when(active & F.col("points").isNotNull(), F.col("ordinal"))).alias("first_hit"),
        F.size(F.collect_set("dict_id")).alias("entries"),
    )


def category_contributions(hits: DataFrame, *keys: str) -> DataFrame:
    return (
        contributions(hits.filter("kind = 'keyword'"), *keys).filter("hit_count > 0")
        .select(*keys, F.col("group_id").alias("category_id"), "hit_count", "points", "first_hit")
    )


def phrase_contributions(hits: DataFrame, *keys: str) -> DataFrame:
    return (
        contributions(hits.filter("kind = 'phrase'"), *keys).filter("hit_count > 0")
        .select(*keys, F.col("group_id").alias("phrase_id"), "hit_count", "points", "first_hit")
    )


def with_description(offers: DataFrame) -> DataFrame:
    """The offers that ingest scores: those that came with a description, be it blank. The others stay without a score."""
    return offers.filter("description IS NOT NULL")


def score_offers(hits: DataFrame, offers: DataFrame, *keys: str) -> DataFrame:
    """One score row per offer, offers without a hit included.

    Bucket points are multiples of a quarter, exact in any order. Phrase
    points are not, so they are folded in first-hit order.
    """
    parts = contributions(hits, *keys)
    every = offers.select(*keys)
    for field in parts.schema:
        if field.name not in keys:
            every = every.withColumn(field.name, F.lit(None).cast(field.dataType))
    rows = parts.unionByName(every)

    keyword = F.col("kind") == "keyword"
    phrase = F.col("kind") == "phrase"
    scored = F.col("hit_count") > 0
    zero = F.lit(0).cast("long")
    bucket = bucket_of(F.col("group_id"))
    sums = [
        F.coalesce(F.sum(F.when(keyword & (bucket == name), F.col("points"))), F.lit(0.0))
        .alias(f"raw_{name}")
        for name in BUCKET_CAPS
    ]
    ranked = F.struct((-F.col("points")).alias("o1"), F.col("first_hit").alias("o2"),
                      F.col("group_id").alias("category_id"), F.col("hit_count"), F.col("points"))
    ordered = F.struct(F.col("first_hit").alias("o1"), F.col("group_id").alias("phrase_id"),
                       F.col("hit_count"), F.col("points"))
    out = rows.groupBy(*keys).agg(
        *sums,
        F.sort_array(F.collect_list(F.when(keyword & scored, ranked))).alias("categories"),
        F.sort_array(F.collect_list(F.when(phrase & scored, ordered))).alias("phrases"),
        F.count_if(keyword).alias("unique_categories"),
        F.coalesce(F.sum(F.when(keyword, F.col("entries"))), zero).alias("unique_keywords"),
        F.coalesce(F.sum(F.when(keyword, F.col("negated_count"))), zero).alias("negated_keyword_hits"),
        F.coalesce(F.sum(F.when(phrase, F.col("negated_count"))), zero).alias("negated_phrase_hits"),
    )
    out = out.withColumns({
        name: F.least(F.col(f"raw_{name}"), F.lit(cap)) for name, cap in BUCKET_CAPS.items()
    })
    out = out.withColumns({
        "core": F.col("raw_direct_fx") >= CORE_THRESHOLD,
        "phrase_points": F.aggregate(
            "phrases", F.lit(0.0), lambda total, p: total + p.getField("points")
        ),
    })
    enough = SYNERGY_MIN_BUCKET
    out = out.withColumns({
        "synergy_intl": F.when(
            F.col("core") & (F.col("intl_footprint") >= enough), F.lit(SYNERGY_INTL)),
        "synergy_biz": F.when(
            F.col("core") & (F.col("business_model") >= enough), F.lit(SYNERGY_BIZ)),
    })
    out = out.withColumn("synergy", F.least(
        F.coalesce("synergy_intl", F.lit(0.0)) + F.coalesce("synergy_biz", F.lit(0.0)),
        F.lit(SYNERGY_MAX),
    ))
    total = (
        F.col("direct_fx") + F.col("intl_footprint") + F.col("business_model")
        + F.col("tech_proxy") + F.col("phrase_points") + F.col("synergy")
    )
    out = out.withColumn(
        "raw_score", F.when(F.col("core"), total).otherwise(F.least(total, F.lit(NO_CORE_CAP)))
    )
    clamped = F.greatest(F.lit(MIN_SCORE), F.least(F.lit(MAX_SCORE), F.col("raw_score")))
    return out.select(
        *keys,
        F.floor(clamped + 0.5).cast("double").alias("score"),
        F.coalesce(F.get("categories", F.lit(0)).getField("category_id"), F.lit(""))
        .alias("top_category_id"),
        "raw_score", "direct_fx", "intl_footprint", "business_model", "tech_proxy",
        "core", (~F.col("core")).alias("no_core_cap"),
        "phrase_points", "synergy", "synergy_intl", "synergy_biz",
        "unique_categories", "unique_keywords", "negated_keyword_hits", "negated_phrase_hits",
        F.transform("categories", lambda c: F.struct(
            c.getField("category_id").alias("category_id"),
            c.getField("hit_count").alias("hit_count"),
            c.getField("points").alias("points"))).alias("categories"),
        F.transform("phrases", lambda p: F.struct(
            p.getField("phrase_id").alias("phrase_id"),
            p.getField("hit_count").alias("hit_count"),
            p.getField("points").alias("points"))).alias("phrases"),
    )


def score_json(scores: DataFrame, *keys: str) -> DataFrame:
    """Rows for the match table: (keys, score, result as JSON text)."""
    reasons = F.struct(
        F.col("raw_score").alias("rawScore"), F.col("score").alias("finalScore"),
        F.transform("categories", lambda c: F.struct(
            c.category_id.alias("categoryId"), c.hit_count.alias("hitCount"), c.points.alias("points")
        )).alias("categories"),
        F.transform("phrases", lambda p: F.struct(
            p.phrase_id.alias("phraseId"), p.hit_count.alias("hitCount"), p.points.alias("points")
        )).alias("phrases"),
        F.col("unique_categories").alias("uniqueCategories"),
        F.col("unique_keywords").alias("uniqueKeywords"),
        F.col("negated_keyword_hits").alias("negatedKeywordHits"),
        F.col("negated_phrase_hits").alias("negatedPhraseHits"),
        F.struct("direct_fx", "intl_footprint", "business_model", "tech_proxy").alias("bucketScores"),
        F.col("core").alias("fxCore"), F.col("no_core_cap").alias("appliedNoFxGuard"),
        F.col("synergy").alias("synergyPoints"),
        F.struct(F.col("synergy_intl").alias("fx_intl"), F.col("synergy_biz").alias("fx_biz"))
        .alias("synergyBreakdown"),
    )
    return scores.select(*keys, "score", F.to_json(F.struct(
        "score", F.col("top_category_id").alias("topCategoryId"), reasons.alias("reasons")
    )).alias("matched_keywords_json"))
