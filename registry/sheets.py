"""Sheet feedback over a sheet made of customer rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.constants import SHEET_HEADERS
from offerlens.operators import feedback
from offerlens.plans import feedback_apply
from registry import query
from registry.merges import RESOLUTION_SQL, resolved_companies
from registry.views import table

CELLS = f"""o_orderkey + 2 AS row_index,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'n/a'
       ELSE ' ' || CAST(o_custkey * 2 AS VARCHAR(20)) || ' ' END AS c0,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'maybe' ELSE lower({RESOLUTION_SQL.format('o_orderkey')}) END AS c2,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'fp' WHEN o_orderpriority = '2-HIGH' THEN ' Ok '
       WHEN o_orderpriority = '3-MEDIUM' THEN 'bad' END AS c10,
  CASE WHEN o_orderstatus = 'F' THEN ' note ' END AS c11"""
SHEET_SQL = f"""WITH sheet AS (SELECT {CELLS} FROM orders),
parsed AS (SELECT row_index, CASE WHEN regexp_matches(trim(c0), '^[0-9]+$') AND trim(c0)::BIGINT > 0
    THEN trim(c0)::BIGINT END AS company_id,
  CASE WHEN c2 <> 'maybe' THEN upper(c2) END AS resolution,
  CASE WHEN upper(trim(c10)) IN ('OK', 'FP', 'FN') THEN upper(trim(c10)) END AS feedback, c10,
  coalesce(trim(c11), '') AS notes FROM sheet),
first_valid AS (SELECT * FROM parsed WHERE company_id IS NOT NULL AND resolution IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY row_index) = 1)
"""


def sheet(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("sheet_orders")
    return spark.sql(f"SELECT {CELLS} FROM sheet_orders")


@query("a12_g1_sheet_index", SHEET_SQL + """
SELECT company_id, row_index, resolution FROM parsed WHERE company_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY row_index) = 1""")
def a12(spark, sf):
    return feedback.read_index(sheet(spark, sf))


@query("a13_h14_resolution_feedback", SHEET_SQL + "SELECT company_id, row_index, resolution FROM first_valid")
def a13(spark, sf):
    return feedback.read_resolutions(sheet(spark, sf))


@query("a13_read_counters", SHEET_SQL + """,
rows AS (SELECT *, row_index % 7 = 0 AS blank FROM parsed),
ok AS (SELECT * FROM rows WHERE NOT blank AND company_id IS NOT NULL AND resolution IS NOT NULL)
SELECT (SELECT count(*) FROM rows) AS total, count(DISTINCT company_id) AS valid,
  (SELECT count(*) FROM rows WHERE NOT blank) - count(*) AS invalid, count(*) - count(DISTINCT company_id) AS duplicate FROM ok""")
def a13_counters(spark, sf):
    """Every seventh row of the sheet is blanked."""
    rows = sheet(spark, sf)
    blanked = rows.select("row_index", *[
        F.when(F.col("row_index") % 7 != 0, F.col(c)).alias(c) for c in rows.columns if c != "row_index"])
    return feedback.read_counters(blanked)


@query("a14_model_feedback", SHEET_SQL + """
SELECT row_index, company_id, feedback, notes, company_id IS NOT NULL AND feedback IS NOT NULL AS is_valid
FROM parsed WHERE c10 IS NOT NULL""")
def a14(spark, sf):
    return feedback.read_model_feedback(sheet(spark, sf))


@query("c11_feedback_window", """
SELECT event_id, hour(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Madrid') BETWEEN 3 AND 5 AS open FROM events""")
def c11(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", feedback.in_feedback_window(F.col("ts").cast("timestamp")).alias("open"))


PLAN_SQL = SHEET_SQL.rstrip() + f""",
stored AS (SELECT c_custkey AS id, {RESOLUTION_SQL.format('c_nationkey')} AS resolution FROM customer),
plan AS (SELECT company_id, s.resolution AS from_resolution, f.resolution AS to_resolution,
  CASE WHEN id IS NULL THEN 'unknown' WHEN s.resolution = f.resolution THEN 'unchanged' ELSE 'changed' END AS state,
  CASE WHEN coalesce(s.resolution, '') NOT IN ('ALREADY_REVOLUT', 'ACCEPTED', 'REJECTED')
        AND f.resolution IN ('ALREADY_REVOLUT', 'ACCEPTED', 'REJECTED') THEN 'destructive'
       WHEN s.resolution IN ('ALREADY_REVOLUT', 'ACCEPTED', 'REJECTED')
        AND f.resolution NOT IN ('ALREADY_REVOLUT', 'ACCEPTED', 'REJECTED') THEN 'reversal'
       ELSE 'informational' END AS classification
  FROM first_valid f LEFT JOIN stored s ON id = company_id)
"""


def plan(spark, sf):
    return feedback.change_plan(
        feedback.read_resolutions(sheet(spark, sf)), resolved_companies(spark, sf))


@query("e8_h21_i4_change_plan", PLAN_SQL + "SELECT * FROM plan")
def e8(spark, sf):
    return plan(spark, sf)


@query("f17_changes_by_target", PLAN_SQL + """
SELECT to_resolution, count(*) AS changes FROM plan WHERE state = 'changed' GROUP BY 1""")
def f17(spark, sf):
    return plan(spark, sf).filter("state = 'changed'").groupBy("to_resolution").agg(
        F.count(F.lit(1)).alias("changes"))


@query("i4_j4_ordered_plan", PLAN_SQL.rstrip() + """
SELECT company_id, classification FROM plan WHERE state = 'changed' ORDER BY classification, company_id""")
def i4(spark, sf):
    return feedback.ordered_plan(plan(spark, sf)).select("company_id", "classification")


@query("k7_b14_feedback_apply", PLAN_SQL.rstrip() + """,
good AS (SELECT company_id, feedback, notes, row_index FROM parsed WHERE c10 IS NOT NULL AND company_id IS NOT NULL AND feedback IS NOT NULL),
ok AS (SELECT count(*) AS n FROM parsed WHERE company_id IS NOT NULL AND resolution IS NOT NULL),
c AS (SELECT * FROM plan WHERE state = 'changed')
SELECT (SELECT count(*) FROM parsed) AS total, (SELECT count(*) FROM first_valid) AS valid,
  (SELECT count(*) FROM parsed) - (SELECT n FROM ok) AS invalid, (SELECT n FROM ok) - (SELECT count(*) FROM first_valid) AS duplicate,
  (SELECT count(*) FROM c) AS changed, (SELECT count(*) FROM plan WHERE state = 'unchanged') AS unchanged,
  (SELECT count(*) FROM plan WHERE state = 'unknown') AS unknown, (SELECT count(*) FROM c WHERE classification = 'destructive') AS destructive,
  (SELECT count(*) FROM c WHERE classification = 'reversal') AS reversal, (SELECT count(*) FROM c WHERE classification = 'informational') AS informational,
  (SELECT count(*) FROM parsed WHERE c10 IS NOT NULL) AS attempted, (SELECT count(*) FROM good) AS persisted,
  (SELECT count(*) FROM parsed WHERE c10 IS NOT NULL) - (SELECT count(*) FROM good) AS failed,
  (SELECT count(*) FROM (SELECT company_id, feedback, notes FROM good EXCEPT SELECT company_id, feedback, notes FROM good WHERE row_index % 2 = 0)) AS inserted,
  (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT company_id FROM c WHERE classification = 'destructive')) AS offers_deleted""")
def k7(spark, sf):
    """Feedback of even rows is stored already."""
    rows = sheet(spark, sf)
    header = spark.range(1).select(F.lit("s").alias("sheet"), F.array(*[F.lit(h) for h in SHEET_HEADERS]).alias("cells"))
    offers = table(spark, sf, "orders").select(F.col("o_orderkey").alias("offer_id"), F.col("o_custkey").alias("company_id"))
    known = feedback.read_model_feedback(rows).filter("is_valid AND row_index % 2 = 0").select("company_id", "feedback", "notes")
    applied = feedback_apply.apply_sheet(
        rows, header, resolved_companies(spark, sf), offers, offers.select("offer_id"), known, F.lit("2024-01-10 03:30:00").cast("timestamp"))
    return applied.counters
