"""Two-key companies and first-wins entries over customer and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import directories, identity
from registry import query
from registry.views import table

STORED = """c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN concat('d', c_custkey) END AS website_domain,
  CASE WHEN c_custkey % 2 = 0 THEN concat('n', c_custkey) END AS normalized_name, c_name AS name_raw,
  CASE WHEN c_acctbal > 0 THEN c_name END AS name_display, c_mktsegment AS website_url"""
ARRIVING = """o_orderkey AS seq, CASE WHEN o_orderkey % 4 > 1 THEN concat('d', o_custkey * 2 % 1700) END AS website_domain,
  CASE WHEN o_orderkey % 5 > 0 THEN concat('n', o_custkey * (1 + o_orderkey % 2) % 1700) END AS normalized_name,
  concat('x', o_orderkey) AS name_raw, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS name_display, o_orderpriority AS website_url"""
KEY = "coalesce('d:' || website_domain, 'n:' || normalized_name)"
SQL = f"""WITH e AS (SELECT {STORED} FROM customer WHERE c_custkey % 6 <> 1 AND c_custkey % 6 <> 5), a AS (SELECT {ARRIVING} FROM orders),
s AS (SELECT normalized_name, arg_min({KEY}, id) AS o FROM e WHERE normalized_name IS NOT NULL GROUP BY 1),
f AS (SELECT normalized_name, arg_min({KEY}, seq) AS o FROM a WHERE normalized_name IS NOT NULL GROUP BY 1),
r AS (SELECT a.*, coalesce('d:' || website_domain, s.o, f.o) AS company_key,
  CASE WHEN website_domain IS NULL AND normalized_name IS NULL THEN 'unidentifiable'
       WHEN 'd:' || website_domain <> coalesce(s.o, f.o) THEN 'conflict' END AS problem
  FROM a LEFT JOIN s USING (normalized_name) LEFT JOIN f USING (normalized_name))
"""


def stored(spark, sf):
    return table(spark, sf, "customer").filter("c_custkey % 6 NOT IN (1, 5)").selectExpr(*_columns(STORED))


def _columns(text):
    out, depth, part = [], 0, ""
    for x in text.replace("\n", " "):
        depth += (x == "(") - (x == ")")
        if x == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += x
    return [*out, part]


def resolved(spark, sf):
    return identity.resolve_companies(stored(spark, sf), table(spark, sf, "orders").selectExpr(*_columns(ARRIVING)))


@query("b1_c3_company_keys", SQL + "SELECT seq, company_key, problem FROM r")
def b1_keys(spark, sf):
    return resolved(spark, sf).select("seq", "company_key", "problem")


@query("b1_two_key_merge", SQL + f""",
n AS (SELECT company_key, {', '.join(f'arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in ('website_domain', *identity.ATTRIBUTES))}
  FROM r WHERE problem IS NULL GROUP BY 1),
o AS (SELECT *, {KEY} AS company_key FROM e)
SELECT o.id, coalesce(n.company_key, o.company_key) AS company_key,
  {', '.join(f'coalesce(n.{c}, o.{c}) AS {c}' for c in ('website_domain', *identity.ATTRIBUTES))}
FROM o FULL JOIN n ON n.company_key = o.company_key""")
def b1_merge(spark, sf):
    return identity.merge_companies(stored(spark, sf), resolved(spark, sf))


@query("e10_b22_rekeyed_offers", """
WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment || '-' || c_nationkey::VARCHAR END AS n FROM customer)
SELECT g.id AS company_id, o_orderkey AS offer_id FROM orders JOIN c ON c.id = o_custkey
JOIN (SELECT n, min(id) AS id FROM c WHERE n IS NOT NULL GROUP BY n) g ON g.n = c.n""")
def e10(spark, sf):
    members = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.when(
        F.col("c_custkey") % 7 > 0, F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string"))).alias("normalized_name"))
    offers = table(spark, sf, "orders").select(F.col("o_custkey").alias("company_id"), F.col("o_orderkey").alias("offer_id"))
    return identity.rekey(offers, members)


@query("g4_first_wins", """
WITH RECURSIVE e AS (SELECT c_mktsegment AS source, c_custkey AS seq, 'd' || (c_custkey * 7 % 60)::VARCHAR AS domain,
    'n' || (c_custkey * 11 % 47)::VARCHAR AS name, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS k FROM customer),
f AS (SELECT source, 0::BIGINT AS k, []::VARCHAR[] AS seen, []::BIGINT[] AS kept FROM (SELECT DISTINCT source FROM e)
  UNION ALL SELECT f.source, e.k, CASE WHEN list_has_any(f.seen, [e.domain, e.name]) THEN f.seen ELSE f.seen || [e.domain, e.name] END,
    CASE WHEN list_has_any(f.seen, [e.domain, e.name]) THEN f.kept ELSE list_append(f.kept, e.seq) END
  FROM f JOIN e ON e.source = f.source AND e.k = f.k + 1)
SELECT source, unnest(arg_max(kept, k)) AS seq FROM f GROUP BY source""")
def g4(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("source"), F.col("c_custkey").alias("seq"),
        F.concat(F.lit("d"), (F.col("c_custkey") * 7 % 60).cast("string")).alias("domain"),
        F.concat(F.lit("n"), (F.col("c_custkey") * 11 % 47).cast("string")).alias("name"))
    return directories.first_wins(rows).select("source", "seq")
