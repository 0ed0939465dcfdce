"""Joins between companies, offers and matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import companies
from registry import query
from registry.views import table


@query("e1_offers_with_scores", """
SELECT o_orderkey AS offer_id, coalesce(s, 0) AS score, CASE WHEN s IS NOT NULL THEN 'cat' || n::VARCHAR END AS category_id
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_quantity) AS s, max(l_linenumber) AS n FROM lineitem GROUP BY 1)
ON l_orderkey = o_orderkey""")
def e1(spark, sf):
    offers = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("offer_id"), F.col("o_custkey").alias("company_id"),
        F.lit(None).cast("string").alias("published_at"), F.lit(None).cast("string").alias("updated_at"),
        F.lit(None).cast("long").alias("canonical_offer_id"), F.lit(0).cast("long").alias("repost_count"))
    matches = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("offer_id")).agg(
        F.max("l_quantity").alias("score"), F.max("l_linenumber").alias("n")).select(
        "offer_id", "score", F.to_json(F.struct(F.concat(F.lit("cat"), F.col("n").cast("string"))
                                                .alias("topCategoryId"))).alias("matched_keywords_json"))
    return companies.offers_with_scores(offers, matches).select("offer_id", "score", "category_id")


@query("e2_companies_without_source", """
SELECT c_custkey AS id FROM customer WHERE c_acctbal IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority IN ('1-URGENT', '2-HIGH'))""")
def e2(spark, sf):
    linked = table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    customer = table(spark, sf, "customer").filter("c_acctbal IS NOT NULL")
    return customer.join(linked, customer.c_custkey == linked.o_custkey, "left_anti").select(
        F.col("c_custkey").alias("id"))


@query("e5_e6_f16_sheet_split", """
SELECT count(*) FILTER (WHERE o IS NULL) AS appended, count(*) FILTER (WHERE o IS NOT NULL) AS updated, count(*) AS total
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders WHERE o_orderstatus = 'F') ON o = c_custkey""")
def e5(spark, sf):
    listed = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("o")).distinct()
    customer = table(spark, sf, "customer")
    return customer.join(listed, customer.c_custkey == listed.o, "left").agg(
        F.count_if(F.col("o").isNull()).alias("appended"), F.count_if(F.col("o").isNotNull()).alias("updated"),
        F.count(F.lit(1)).alias("total"))


@query("e12_tenant_offers", """
SELECT o_orderkey AS offer_id, s_suppkey AS company_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey WHERE l_linenumber = 1""")
def e12(spark, sf):
    lines = table(spark, sf, "lineitem").filter("l_linenumber = 1")
    orders, supplier = table(spark, sf, "orders"), table(spark, sf, "supplier")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).join(
        supplier, supplier.s_suppkey == lines.l_suppkey).select(
        F.col("o_orderkey").alias("offer_id"), F.col("s_suppkey").alias("company_id"))
