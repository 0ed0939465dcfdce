"""Merges over customer and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import merges
from registry import query
from registry.views import table


def companies(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") > 3000, F.col("c_name")).alias("name_display"),
        F.col("c_mktsegment").alias("segment"))


def company_updates(spark, sf):
    return table(spark, sf, "orders").select(
        (F.col("o_custkey") + 50).alias("id"), F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("N"), F.col("o_orderkey").cast("string")))
        .alias("name_display"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("segment"))


UPDATES_SQL = """WITH e AS (SELECT c_custkey AS id, CASE WHEN c_acctbal > 3000 THEN c_name END AS name_display,
  c_mktsegment AS segment FROM customer),
u AS (SELECT o_custkey + 50 AS id, o_orderkey AS seq,
  CASE WHEN o_orderstatus = 'O' THEN 'N' || o_orderkey::VARCHAR END AS name_display,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS segment FROM orders),
f AS (SELECT id, arg_max(name_display, seq) FILTER (WHERE name_display IS NOT NULL) AS name_display,
  arg_max(segment, seq) FILTER (WHERE segment IS NOT NULL) AS segment FROM u GROUP BY id),
l AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
"""


@query("b1_g7_company_merge", UPDATES_SQL + """
SELECT id, coalesce(f.name_display, e.name_display) AS name_display,
       coalesce(f.segment, e.segment) AS segment FROM e FULL JOIN f USING (id)""")
def b1(spark, sf):
    folded = merges.latest_values(company_updates(spark, sf), ["id"], "seq", ["name_display", "segment"])
    return merges.merge_coalesce(companies(spark, sf), folded, ["id"])


@query("b4_b5_b7_row_upsert", UPDATES_SQL + """
SELECT id, CASE WHEN l.id IS NOT NULL THEN l.name_display ELSE e.name_display END AS name_display,
       CASE WHEN l.id IS NOT NULL THEN l.segment ELSE e.segment END AS segment
FROM e FULL JOIN l USING (id)""")
def b4(spark, sf):
    last = merges.last_rows(company_updates(spark, sf), ["id"], "seq")
    return merges.merge_overwrite(companies(spark, sf), last, ["id"])


RESOLUTION_SQL = """CASE {0} % 6 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'HIGH_INTEREST'
  WHEN 3 THEN 'ALREADY_REVOLUT' WHEN 4 THEN 'ACCEPTED' ELSE 'REJECTED' END"""


def resolution(expr):
    return F.expr(RESOLUTION_SQL.format(expr))


def resolved_companies(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), resolution("c_nationkey").alias("resolution"))


def resolution_changes(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", resolution("o_orderkey").alias("resolution"))
    return merges.last_rows(orders, ["id"], "o_orderkey")


CHANGES_SQL = f"""WITH e AS (SELECT c_custkey AS id, {RESOLUTION_SQL.format('c_nationkey')} AS resolution FROM customer),
n AS (SELECT o_custkey AS id, {RESOLUTION_SQL.format('max(o_orderkey)')} AS resolution FROM orders GROUP BY 1)
"""


@query("b11_resolution_update", CHANGES_SQL + """
SELECT e.id, coalesce(n.resolution, e.resolution) AS resolution,
       n.id IS NOT NULL AND n.resolution <> e.resolution AS changed FROM e LEFT JOIN n USING (id)""")
def b11(spark, sf):
    return merges.update_resolution(resolved_companies(spark, sf), resolution_changes(spark, sf))


@query("b12_delete_with_cascade", """
SELECT l_orderkey AS offer_id, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1""")
def b12(spark, sf):
    gone = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("company_id"))
    offers = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("offer_id"), F.col("o_custkey").alias("company_id"))
    matches = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("offer_id"))
    return merges.cascade(matches, merges.delete_offers(offers, gone)).groupBy("offer_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("b13_j1_insert_ignore", """
SELECT o_custkey AS company, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS notes, min(o_orderkey) AS event_id
FROM orders WHERE o_orderstatus <> 'P' OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) GROUP BY ALL""")
def b13(spark, sf):
    events = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("company"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("notes"), F.col("o_orderkey").alias("event_id"))
    existing = table(spark, sf, "customer").filter("c_nationkey < 20").select(
        F.col("c_custkey").alias("company"), F.lit(None).cast("string").alias("notes"))
    return merges.insert_ignore(existing, events, ["company", "notes"])


@query("b22_e10_companies_by_name", """
SELECT c_mktsegment || '-' || c_nationkey::VARCHAR AS normalized_name, min(c_acctbal) AS created_at,
       max(c_acctbal) AS updated_at, min(c_custkey) AS first_id, count(*) AS members FROM customer GROUP BY 1""")
def b22(spark, sf):
    return merges.companies_by_name(table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("created_at"),
        F.col("c_acctbal").alias("updated_at"),
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("normalized_name")))


@query("b8_partial_update", """
SELECT o_orderkey AS id, CASE WHEN l_returnflag = 'R' THEN l_linestatus ELSE o_orderstatus END AS status,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE o_orderpriority END AS priority
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_returnflag) AS l_returnflag, max(l_linestatus) AS l_linestatus
  FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def b8(spark, sf):
    existing = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"))
    updates = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.max("l_linestatus").alias("status"), F.lit(None).cast("string").alias("priority"),
        F.max("l_returnflag").alias("flag")).withColumns({
            "set_status": F.col("flag") == "R", "set_priority": F.col("flag") == "A"})
    return merges.partial_update(existing, updates, "id")
