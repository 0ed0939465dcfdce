"""Composite jobs: ingest and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import companies, export, gates
from offerlens.plans import ingest
from registry import query
from registry import views as v
from registry.merges import RESOLUTION_SQL, resolution
from registry.reposts import FOLD_SQL, KEYS_SQL
from registry.signals import ORDER_OFFERS_SQL, order_offers
from registry.views import table, with_sql

URL_CASE = "CASE WHEN lang = 'fr' AND n_chars < 900 THEN '  ' ELSE 'https://x.test/' || CAST(doc_id AS VARCHAR(20)) END"
GATE_SQL = f"""CASE WHEN trim({URL_CASE}) = '' THEN 'missing_provider_url'
  WHEN {RESOLUTION_SQL.format("CAST(substr(source, 4) AS INTEGER)")} IN ('ALREADY_REVOLUT', 'ACCEPTED', 'REJECTED')
  THEN 'company_resolved' END"""


def arriving(spark, sf):
    extra = table(spark, sf, "documents").select(
        F.col("doc_id").alias("offer_id"), F.expr(URL_CASE).alias("provider_url"),
        F.when(F.col("lang") == "es", "lever").otherwise("infojobs").alias("provider"))
    return v.document_offers(spark, sf).join(extra, "offer_id").withColumns({
        "provider_offer_id": F.col("offer_id").cast("string"), "seen_at": F.col("published_at")})


def source_companies(spark, sf):
    return table(spark, sf, "documents").select(F.col("source").alias("id")).distinct().withColumn(
        "resolution", resolution("CAST(substr(id, 4) AS INTEGER)"))


@query("c1_c5_gate_outcome", f"SELECT doc_id AS offer_id, {GATE_SQL} AS outcome FROM documents")
def c1_c5(spark, sf):
    return gates.gate_offers(arriving(spark, sf), source_companies(spark, sf)).select("offer_id", "outcome")


K1_SQL = ("WITH RECURSIVE gated AS (SELECT *, " + GATE_SQL + " AS outcome FROM documents),\n"
          + KEYS_SQL.replace("FROM documents)", "FROM gated WHERE outcome IS NULL)") + ",\n" + FOLD_SQL + """,
outcomes AS (SELECT doc_id AS offer_id, source AS company_id, outcome, NULL::BIGINT AS canonical_id FROM gated
  WHERE outcome IS NOT NULL UNION ALL SELECT offer_id, company_id,
  CASE WHEN canonical_id IS NULL THEN 'inserted' ELSE 'repost_duplicate' END, canonical_id FROM folded)
""")


@query("k1_ingest_outcomes", K1_SQL + "SELECT * FROM outcomes")
def k1(spark, sf):
    return ingest.ingest_outcomes(arriving(spark, sf), source_companies(spark, sf))


METRICS_SQL = with_sql(ORDER_OFFERS_SQL, v.COMPANY_METRICS_SQL).rstrip() + """,
export AS (SELECT c_custkey AS company_id, c_name AS company_name, 'PENDING' AS resolution,
  coalesce(printf('%.1f', max_score), '') AS max_score, coalesce(strong_offer_count::VARCHAR, '') AS strong_offer_count,
  coalesce(unique_offer_count::VARCHAR, '') AS unique_offer_count, coalesce(offer_count::VARCHAR, '') AS offer_count,
  coalesce('https://x.test/' || top_offer_id::VARCHAR, '') AS top_offer_url,
  coalesce(r_name, '') AS top_category, coalesce(left(last_strong_at, 10), '') AS last_strong_at
  FROM customer LEFT JOIN company_metrics ON company_id = c_custkey
  LEFT JOIN region ON left(top_category_id, 1) = (r_regionkey + 1)::VARCHAR)
"""


def exported(spark, sf):
    metrics = companies.aggregate_companies(order_offers(spark, sf)).withColumn(
        "top_category_id", F.substring("top_category_id", 1, 1))
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name_display"),
        F.lit(None).cast("string").alias("normalized_name"))
    joined = base.join(metrics, base.id == metrics.company_id, "left")
    urls = table(spark, sf, "orders").select(F.col("o_orderkey").alias("offer_id"), F.concat(
        F.lit("https://x.test/"), F.col("o_orderkey").cast("string")).alias("url"))
    categories = table(spark, sf, "region").select(
        (F.col("r_regionkey") + 1).cast("string").alias("id"), F.col("r_name").alias("name"))
    return export.export_rows(joined, urls, categories)


@query("b20_h15_e7_e9_export_rows", METRICS_SQL + "SELECT * FROM export")
def b20(spark, sf):
    return exported(spark, sf)


SHEETED = "SELECT DISTINCT o_custkey AS c, min(o_orderkey) AS row_index FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"


def sheeted(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(
        F.col("o_custkey").alias("company_id")).agg(F.min("o_orderkey").alias("row_index"))


@query("b18_append_batches", METRICS_SQL.rstrip() + f""", sheet AS ({SHEETED})
SELECT company_id, company_name, (row_number() OVER (ORDER BY company_id) - 1) // 100 AS batch_no
FROM export WHERE company_id NOT IN (SELECT c FROM sheet)""")
def b18(spark, sf):
    return export.appended(exported(spark, sf), sheeted(spark, sf)).select("company_id", "company_name", "batch_no")


@query("b19_metric_updates", METRICS_SQL.rstrip() + f""", sheet AS ({SHEETED})
SELECT row_index, max_score, strong_offer_count, unique_offer_count, offer_count, top_offer_url, top_category,
  last_strong_at FROM export JOIN sheet ON c = company_id""")
def b19(spark, sf):
    return export.metric_updates(exported(spark, sf), sheeted(spark, sf))
