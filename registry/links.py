"""Provider links, metric write-back and feedback apply."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import companies, company_sources
from registry import query
from registry.merges import resolved_companies
from registry.sheets import PLAN_SQL, plan
from registry.signals import ORDER_OFFERS_SQL, order_offers
from registry.views import COMPANY_METRICS_SQL, table, with_sql

LINKS_SQL = """WITH e AS (SELECT 'p' || s_nationkey::VARCHAR AS provider, s_suppkey AS company_id,
  CASE WHEN s_acctbal > 0 THEN (s_suppkey % 700)::VARCHAR END AS provider_company_id, s_name AS url FROM supplier),
u AS (SELECT 'p' || (o_orderkey % 25)::VARCHAR AS provider, o_custkey AS company_id, o_orderkey AS seq,
  CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey % 900)::VARCHAR END AS provider_company_id,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS url FROM orders)
"""


def links(spark, sf):
    existing = table(spark, sf, "supplier").select(
        F.concat(F.lit("p"), F.col("s_nationkey").cast("string")).alias("provider"),
        F.col("s_suppkey").alias("company_id"),
        F.when(F.col("s_acctbal") > 0, (F.col("s_suppkey") % 700).cast("string")).alias("provider_company_id"),
        F.col("s_name").alias("url"))
    updates = table(spark, sf, "orders").select(
        F.concat(F.lit("p"), (F.col("o_orderkey") % 25).cast("string")).alias("provider"),
        F.col("o_custkey").alias("company_id"), F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") != "P", (F.col("o_orderkey") % 900).cast("string"))
        .alias("provider_company_id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("url"))
    return existing, updates


CLAIMS_SQL = LINKS_SQL + """,
l AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY company_id, provider ORDER BY seq DESC) = 1),
held AS (SELECT provider, provider_company_id, min(company_id) AS holder FROM e WHERE provider_company_id IS NOT NULL GROUP BY 1, 2),
claims AS (SELECT provider, provider_company_id, min(company_id) AS first_claim FROM l WHERE provider_company_id IS NOT NULL GROUP BY 1, 2),
judged AS (SELECT l.*, coalesce(coalesce(holder, first_claim) <> company_id, false) AS refused
  FROM l LEFT JOIN held USING (provider, provider_company_id) LEFT JOIN claims USING (provider, provider_company_id)),
a AS (SELECT * FROM judged WHERE NOT refused)
"""


@query("b3_links_by_company", CLAIMS_SQL + """
SELECT company_id, provider, CASE WHEN a.seq IS NOT NULL THEN a.provider_company_id ELSE e.provider_company_id END AS provider_company_id,
  CASE WHEN a.seq IS NOT NULL THEN a.url ELSE e.url END AS url FROM e FULL JOIN a USING (company_id, provider)""")
def b3(spark, sf):
    return company_sources.merge_by_company(*links(spark, sf))[0]


@query("b3_refused_links", CLAIMS_SQL + "SELECT company_id, provider, provider_company_id, url FROM judged WHERE refused")
def b3_refused(spark, sf):
    return company_sources.merge_by_company(*links(spark, sf))[1]


@query("b10_metrics_update", with_sql(ORDER_OFFERS_SQL, COMPANY_METRICS_SQL) + """
SELECT c_custkey AS id, c_name AS name_display, CASE WHEN company_id IS NOT NULL THEN max_score ELSE c_acctbal END AS max_score,
  top_offer_id FROM customer LEFT JOIN company_metrics ON company_id = c_custkey""")
def b10(spark, sf):
    null = F.lit(None)
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name_display"), F.col("c_acctbal").alias("max_score"),
        *[null.cast("long").alias(c) for c in ("offer_count", "unique_offer_count", "strong_offer_count", "top_offer_id")],
        null.cast("double").alias("avg_strong_score"),
        *[null.cast("string").alias(c) for c in ("top_category_id", "category_max_scores", "last_strong_at")])
    metrics = companies.aggregate_companies(order_offers(spark, sf))
    return companies.update_metrics(base, metrics).select("id", "name_display", "max_score", "top_offer_id")


@query("b21_feedback_resolutions", PLAN_SQL.rstrip() + """
SELECT id, CASE WHEN state = 'changed' THEN to_resolution ELSE resolution END AS resolution
FROM stored LEFT JOIN plan ON company_id = id""")
def b21(spark, sf):
    offers = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("company_id"))
    return company_sources.apply_feedback(plan(spark, sf), resolved_companies(spark, sf), offers)[0]


@query("b21_offers_after_feedback", PLAN_SQL.rstrip() + """
SELECT o_orderkey, o_custkey AS company_id FROM orders WHERE o_custkey NOT IN (
  SELECT company_id FROM plan WHERE state = 'changed' AND classification = 'destructive')""")
def b21_offers(spark, sf):
    offers = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("company_id"))
    return company_sources.apply_feedback(plan(spark, sf), resolved_companies(spark, sf), offers)[1]


@query("a15_header_check", """
WITH h AS (SELECT n_nationkey::BIGINT AS sheet, unnest([n_name, n_name || 'x']) AS actual, unnest(['NATION_1', 'NATION_2x']) AS expected,
  unnest([0, 1]) AS pos FROM nation)
SELECT sheet, pos::BIGINT AS pos, expected, actual FROM h WHERE expected <> actual""")
def a15(spark, sf):
    header = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("sheet"),
        F.array(F.concat(F.lit(" "), "n_name"), F.concat("n_name", F.lit("x"))).alias("cells"))
    return company_sources.header_mismatches(header, ("NATION_1", "NATION_2x")).withColumn(
        "pos", F.col("pos").cast("long"))


@query("b2_links_by_provider_id", LINKS_SQL + """,
l AS (SELECT provider, provider_company_id, arg_max(company_id, seq) AS company_id, arg_max(url, seq) FILTER (WHERE url IS NOT NULL) AS url
  FROM u WHERE provider_company_id IS NOT NULL GROUP BY ALL),
en AS (SELECT * FROM e WHERE provider_company_id IS NOT NULL)
SELECT provider, provider_company_id, coalesce(l.company_id, en.company_id) AS company_id, coalesce(l.url, en.url) AS url
FROM en FULL JOIN l USING (provider, provider_company_id)
UNION ALL SELECT provider, provider_company_id, company_id, url FROM e WHERE provider_company_id IS NULL
UNION ALL SELECT provider, provider_company_id, company_id, url FROM u WHERE provider_company_id IS NULL""")
def b2(spark, sf):
    return company_sources.merge_by_provider_id(*links(spark, sf))
