"""Offer batch ingest as one job: gates, companies, repost fold, upserts, scores, company metrics, counters, ledger.

The state is five tables that are committed together (``SCHEMAS``). ``plan_batch`` is the batch as a plan over them;
``run_offer_batch`` runs it, commits the tables and writes the ledger.

Rules, in the order of the gates: an offer needs an absolute URL; one of an applicant system needs a description; its company
needs a domain or a name (offers with a known company skip this); offers of resolved companies go. A stored
(provider, provider_offer_id) is an update, whose content counts for the offers behind it in the batch. The rest is folded in arrival order
into the canonical offers of its company: a repost only adds to the counter of its canonical offer, others are inserted.
Of several rows with one new key the first is folded; the later ones update it, or are further reposts if it was one.

A company's domain and name that belong to two stored companies make the offer ``failed``. Every offer without a provider's company
id adds a link of its own, as links without an id cannot be told apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from offerlens.operators import companies as metrics
from offerlens.operators import gates, identity, matching, merges, reposts, scoring
from offerlens.operators.company_sources import merge_by_provider_id
from offerlens.operators.ledger import COUNTERS, LEDGER
from offerlens.operators.numbering import numbered
from offerlens.session import local_frame, materialized, materialized_result, scratch
from offerlens.sinks.snapshots import Snapshots

#: Columns of an offer that every update overwrites, nulls included.
CONTENT = ("provider_url", "company_id", "title", "description", "min_requirements", "desired_requirements", "requirements_snippet",
           "published_at", "updated_at", "created_at", "applications_count", "metadata_json")
ARRIVING = """seq long, provider string, provider_offer_id string, provider_url string, known_company_id long,
    provider_company_id string, company_name string, company_name_raw string, normalized_name string, website_url string,
    website_domain string, hidden boolean, title string, description string, min_requirements string, desired_requirements string,
    requirements_snippet string, published_at string, updated_at string, created_at string, applications_count string, metadata_json string"""
SCHEMAS = {
    "companies": """id long, name_raw string, name_display string, normalized_name string, website_url string, website_domain string,
        resolution string, max_score double, offer_count long, unique_offer_count long, strong_offer_count long, avg_strong_score double,
        top_category_id string, top_offer_id long, category_max_scores string, last_strong_at string""",
    "company_sources": "provider string, provider_company_id string, company_id long, url string, hidden boolean, raw_json string",
    "offers": """offer_id long, provider string, provider_offer_id string, provider_url string, company_id long, title string,
        description string, min_requirements string, desired_requirements string, requirements_snippet string, published_at string,
        updated_at string, created_at string, applications_count string, metadata_json string, last_updated_at string,
        canonical_offer_id long, repost_count long, last_seen_at string, content_fingerprint string""",
    "matches": "offer_id long, score double, matched_keywords_json string, computed_at string",
    "outcomes": """seq long, provider string, provider_offer_id string, company_id long, outcome string, offer_id long,
        canonical_id long, reason string, similarity double""",
}
STORED = ("inserted", "updated")
GATES = ("missing_provider_url", "missing_description", "company_unidentifiable", "company_resolved")
KEY = ["provider", "provider_offer_id"]


def _highest(rows: DataFrame, name: str) -> int:
    return rows.agg(F.max(name)).first()[0] or 0


def with_identity(offers: DataFrame) -> DataFrame:
    """Domain and name as given, else derived from the website and the name as written."""
    own = gates.identity(F.coalesce("company_name_raw", "company_name"), F.col("website_url"))
    return offers.withColumns({
        "website_domain": F.coalesce(F.nullif("website_domain", F.lit("")), own["domain"]),
        "normalized_name": F.coalesce(F.nullif("normalized_name", F.lit("")), own["name"]),
        "name_raw": F.coalesce("company_name_raw", "company_name"), "name_display": F.col("company_name")})


def merged_companies(stored: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(companies, keys): the company table after the arrivals, and company_key -> id. New ids follow the order of arrival."""
    merged = materialized(identity.merge_companies(stored, resolved))
    first = resolved.filter("problem IS NULL").groupBy("company_key").agg(F.min("seq").alias("first_seq"))
    new = numbered(merged.filter("id IS NULL").drop("id").join(first, "company_key"), "first_seq")
    fresh = new.withColumn("id", F.lit(_highest(stored, "id")) + F.col("position"))
    every = materialized(merged.filter("id IS NOT NULL").unionByName(fresh.select(*merged.columns)))
    rest = stored.select("id", "resolution", *metrics.METRICS)
    table = every.join(rest, "id", "left").withColumn("resolution", F.coalesce("resolution", F.lit("PENDING")))
    return table, every.select("company_key", "id")


def gated_offers(offers: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(offers with company_id and outcome, company table): the outcome is the first gate that rejects, else null."""
    named = with_identity(offers)
    early = gates.gate_outcome(F.lit(0), F.lit(None).cast("string")).isNull()
    unknown = named.filter(early & F.col("known_company_id").isNull())
    columns = ["seq", "website_domain", "normalized_name", "name_raw", "name_display", "website_url"]
    resolved = materialized(identity.resolve_companies(stored, unknown.select(*columns)))
    table, keys = merged_companies(stored, resolved)
    table = materialized(table)
    found = resolved.join(keys, "company_key", "left").select("seq", "problem", F.when(F.col("problem").isNull(), F.col("id")).alias("found_id"))
    placed = named.join(found, "seq", "left").withColumn("company_id", F.coalesce("known_company_id", "found_id")).drop("found_id")
    judged = gates.gate_offers(placed, table)
    clash = (F.col("outcome") == "company_unidentifiable") & (F.col("problem") == "conflict")
    return judged.withColumn("outcome", F.when(clash, "failed").otherwise(F.col("outcome"))).drop("resolution", "problem"), table


def stored_versions(stored: DataFrame, updates: DataFrame, touched: DataFrame) -> DataFrame:
    """Contents of the stored canonical offers of the batch's companies, each with the arrivals it counts for.

    ``updates``: arrival, offer_id and content of the batch's updates. An offer keeps the fingerprint it was stored with.
    """
    known = reposts.canonical_candidates(stored)
    seen = F.coalesce("last_seen_at", "published_at", "updated_at")
    first = known.select("offer_id", F.lit(None).cast("long").alias("from_seq"), "company_id", "title", "description", seen.alias("seen_at"))
    later = updates.join(known.select("offer_id"), "offer_id", "left_semi").select(
        "offer_id", F.col("arrival").alias("from_seq"), "company_id", "title", "description", "seen_at")
    ordered = Window.partitionBy("offer_id").orderBy(F.asc_nulls_first("from_seq"))
    every = first.unionByName(later).withColumn("until_seq", F.lead("from_seq").over(ordered))
    return every.join(known.select("offer_id", "content_fingerprint"), "offer_id").join(touched, "company_id", "left_semi")


def offer_outcomes(judged: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per arriving offer in the layout of ``SCHEMAS['outcomes']``."""
    top = _highest(stored, "offer_id")
    passed = judged.filter("outcome IS NULL").drop("outcome").withColumn("arrival", F.col("seq") + (top + 1))
    old = passed.join(stored.select(*KEY, "offer_id"), KEY)
    new = passed.join(stored.select(*KEY), KEY, "left_anti")
    first = new.groupBy(*KEY).agg(F.min("arrival").alias("arrival"))
    fresh = new.join(first.select("arrival"), "arrival", "left_semi")
    touched = fresh.select("company_id").distinct()
    folded = materialized_result(judged.sparkSession, lambda: reposts.fold_reposts(
        fresh.select("company_id", F.col("arrival").alias("offer_id"), "title", "description", "seen_at"), stored_versions(stored, old, touched)))
    ids = numbered(folded.filter("NOT is_repost").select(F.col("offer_id").alias("arrival")), "arrival").select(
        "arrival", (F.lit(top) + F.col("position")).alias("new_id"))
    settled = folded.withColumnRenamed("offer_id", "arrival").join(ids, "arrival", "left").join(
        ids.select(F.col("arrival").alias("canonical_id"), F.col("new_id").alias("canonical_new")), "canonical_id", "left").select(
        "arrival", "new_id", F.coalesce("canonical_new", "canonical_id").alias("canonical_id"), "reason", "similarity")
    # every row of a new key follows its first one
    followed = new.join(first.withColumnRenamed("arrival", "first_arrival"), KEY).join(
        settled.withColumnRenamed("arrival", "first_arrival"), "first_arrival")
    kind = F.when(F.col("canonical_id").isNotNull(), "repost_duplicate").when(F.col("arrival") == F.col("first_arrival"), "inserted").otherwise("updated")
    none = F.lit(None)
    base = ["seq", *KEY, "company_id"]
    parts = [
        judged.filter("outcome IS NOT NULL").select(*base, "outcome", none.cast("long").alias("offer_id"), none.cast("long").alias("canonical_id"),
                                                     none.cast("string").alias("reason"), none.cast("double").alias("similarity")),
        old.select(*base, F.lit("updated").alias("outcome"), "offer_id", none.cast("long").alias("canonical_id"),
                   none.cast("string").alias("reason"), none.cast("double").alias("similarity")),
        followed.select(*base, kind.alias("outcome"), F.col("new_id").alias("offer_id"), "canonical_id", "reason", "similarity"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def updated_offers(stored: DataFrame, accepted: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """The offer table after the batch. ``accepted``: outcomes with content and seen_at of their offers."""
    rows = accepted.filter(F.col("outcome").isin(*STORED))
    last = merges.last_rows(rows.select("offer_id", "seq", *KEY, *CONTENT, as_of.alias("last_updated_at")), ["offer_id"], "seq").drop("seq")
    keep = ("canonical_offer_id", "repost_count", "last_seen_at", "content_fingerprint")
    upserted = merges.merge_overwrite(stored, last, ["offer_id"], keep)
    prints = reposts.with_repost_keys(rows.filter("outcome = 'inserted'").select("offer_id", "title", "description")).select(
        "offer_id", F.col("fingerprint").alias("new_print"))
    filled = upserted.join(prints, "offer_id", "left").withColumns({
        "content_fingerprint": F.coalesce("content_fingerprint", "new_print"),
        "repost_count": F.coalesce("repost_count", F.lit(0).cast("long"))}).drop("new_print")
    seen = accepted.select(F.coalesce("canonical_id", "offer_id").alias("canonical_id"), "seq", "seen_at", (F.col("outcome") == "repost_duplicate").alias("again"))
    events = seen.groupBy("canonical_id").agg(F.count_if("again").alias("reposts"), F.max_by("seen_at", "seq").alias("last_seen_at"))
    return reposts.apply_repost_counters(filled, events)


def updated_matches(stored: DataFrame, accepted: DataFrame, patterns: DataFrame, as_of: Column) -> DataFrame:
    """The match table after the batch: the last content of each offer that came with a description is scored."""
    rows = scoring.with_description(accepted.filter(F.col("outcome").isin(*STORED)))
    last = materialized(merges.last_rows(rows.select("offer_id", "seq", "title", "description"), ["offer_id"], "seq").drop("seq"))
    scores = scoring.score_offers(matching.match_offers(last, patterns, "offer_id"), last, "offer_id")
    new = scoring.score_json(scores, "offer_id").withColumn("computed_at", as_of)
    return merges.merge_overwrite(stored, new, ["offer_id"])


def company_links(stored: DataFrame, judged: DataFrame) -> DataFrame:
    """Links of the companies that the batch identified."""
    rows = judged.filter(F.col("known_company_id").isNull() & F.col("company_id").isNotNull()).select(
        "seq", "provider", "provider_company_id", "company_id", F.lit(None).cast("string").alias("url"),
        F.coalesce("hidden", F.lit(False)).alias("hidden"), F.lit(None).cast("string").alias("raw_json"))
    return merge_by_provider_id(stored, rows)


def counters(outcomes: DataFrame) -> list[Column]:
    """The batch's counters as aggregates over its outcomes."""
    o = F.col("outcome")
    return [
        F.count(F.lit(1)).alias("offers_fetched"), F.count_if(o.isin(*STORED)).alias("offers_upserted"),
        F.count_if(o == "repost_duplicate").alias("offers_duplicates"), F.count_if(o.isin(*GATES)).alias("offers_skipped"),
        F.count_if(o == "failed").alias("offers_failed"), F.count_if(o == "missing_description").alias("offers_skipped_missing_description"),
        F.count_if(o == "repost_duplicate").alias("offers_skipped_repost_duplicate")]


def affected_companies(outcomes: DataFrame) -> DataFrame:
    """company_id of the companies whose offers the batch touched, resolved ones included."""
    return outcomes.filter(F.col("outcome").isin(*STORED, "repost_duplicate", "company_resolved") & F.col("company_id").isNotNull()).select("company_id").distinct()


def plan_batch(state: dict[str, DataFrame], offers: DataFrame, patterns: DataFrame, as_of: str, observed: Observation | None = None) -> dict[str, DataFrame]:
    """The state's tables after the batch, and its ``outcomes``. ``offers``: ``ARRIVING``; ``seq`` from 0 in arrival order."""
    now = F.lit(as_of)
    judged, companies = gated_offers(offers, state["companies"])
    judged = materialized(judged.withColumn("seen_at", gates.seen_at(F.col("updated_at"), F.col("published_at"), now)))
    found = offer_outcomes(judged, state["offers"])
    outcomes = materialized(found.observe(observed, *counters(found)) if observed is not None else found)
    content = judged.select("seq", "seen_at", *[c for c in CONTENT if c != "company_id"])
    accepted = outcomes.filter(F.col("outcome").isin(*STORED, "repost_duplicate")).join(content, "seq")
    stored = materialized(updated_offers(state["offers"], accepted, outcomes, now))
    matches = materialized(updated_matches(state["matches"], accepted, patterns, now))
    affected = affected_companies(outcomes)
    scored = metrics.offers_with_scores(stored.join(affected, "company_id", "left_semi"), matches)
    fresh = materialized(metrics.aggregate_affected(scored, affected))
    return {
        "companies": metrics.update_metrics(companies, fresh), "company_sources": company_links(state["company_sources"], judged),
        "offers": stored, "matches": matches, "outcomes": outcomes, "metrics": fresh}


def run_offer_batch(
    snapshots: Snapshots, ledger: str, provider: str, offers: DataFrame, patterns: DataFrame, as_of: Callable[[], str], batch: str,
    query_key: str | None = None,
) -> dict[str, int] | None:
    """Run one batch and commit it; None if ``batch`` is committed already.

    The ledger gets an opening row, and a closing one with status success or failure and the counters so far. Counters of
    outcomes are collected while the outcome table is written. The tables between the steps go with the batch.
    """
    if snapshots.has(batch):
        return None
    spark, run_id, observed = snapshots.spark, f"{batch}/{uuid.uuid4().hex}", Observation()
    counts: dict[str, int] = {}

    def note(status: str, error: str | None = None) -> None:
        row = (run_id, provider, query_key, as_of(), status, error, *[counts.get(name) for name in COUNTERS])
        local_frame(spark, [row], LEDGER).coalesce(1).write.mode("append").parquet(ledger)

    note("running")
    try:
        with scratch(spark):
            tables = plan_batch(snapshots.tables(), offers, patterns, as_of(), observed)
            counts |= observed.get
            fresh = tables.pop("metrics")
            lost = metrics.metrics_without_company(tables["companies"], fresh).count()
            counts |= {"affected_companies": fresh.count(), "companies_failed": lost}
            counts["companies_aggregated"] = counts["affected_companies"] - lost
            snapshots.commit(batch, tables)
    except Exception as e:
        note("failure", f"{type(e).__name__}: {e}"[:500])
        raise
    note("success")
    return counts
