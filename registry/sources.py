"""Listing sources over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.constants import JOBS_PER_TENANT, LISTING_MAX_OFFERS, LISTING_MAX_PAGES
from offerlens.sources import listings, payloads
from registry import query
from registry.views import table


@query("a5_i9_g8_jobs_per_tenant", """
SELECT o_orderpriority AS tenant, o_orderkey AS id FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)
WHERE rn <= 200 AND o_orderstatus <> 'P'""")
def a5(spark, sf):
    jobs = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("tenant"), F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("title"), F.lit("u").alias("url"))
    return listings.first_per_tenant(jobs, cap=JOBS_PER_TENANT).select("tenant", "id")


PAGES_SQL = """WITH raw AS (SELECT o_orderpriority AS listing,
    o_orderkey // 400 + CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey >= 1200 THEN 1 ELSE 0 END AS page_no, o_orderkey % 400 AS pos,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS offer_id FROM orders),
ends AS (SELECT listing, min(page_no) AS stop FROM (SELECT DISTINCT listing, page_no + 1 AS page_no FROM raw
    UNION SELECT DISTINCT listing, 0 FROM raw) p
    WHERE NOT EXISTS (SELECT 1 FROM raw r WHERE r.listing = p.listing AND r.page_no = p.page_no) GROUP BY 1),
v AS (SELECT raw.* FROM raw JOIN ends USING (listing) WHERE page_no < stop AND offer_id IS NOT NULL),
kept AS (SELECT * FROM v WHERE page_no < 10 QUALIFY row_number() OVER (PARTITION BY listing ORDER BY page_no, pos) <= 500)
"""


def listing_rows(spark, sf):
    """Orders as pages of 400 keys; one listing has an empty page in between."""
    gap = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") >= 1200)
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("listing"),
        (F.floor(F.col("o_orderkey") / 400) + gap.cast("long")).alias("page_no"),
        (F.col("o_orderkey") % 400).alias("pos"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("offer_id"))


@query("a6_paged_listing", PAGES_SQL + "SELECT listing, page_no, offer_id FROM kept")
def a6(spark, sf):
    return listings.paged_listing(listing_rows(spark, sf), LISTING_MAX_PAGES, LISTING_MAX_OFFERS).select(
        "listing", "page_no", "offer_id")


@query("a6_whole_listing", PAGES_SQL + "SELECT listing, page_no, offer_id FROM v")
def a6_whole(spark, sf):
    return listings.paged_listing(listing_rows(spark, sf)).select("listing", "page_no", "offer_id")


@query("a6_listing_counters", PAGES_SQL + """
SELECT listing, count(DISTINCT k.page_no) AS pages, count(k.offer_id) AS offers,
  CASE WHEN count(k.offer_id) < count(*) THEN CASE WHEN count(k.offer_id) >= 500 THEN 'maxOffers' ELSE 'maxPages' END END AS truncated_by
FROM v LEFT JOIN kept k USING (listing, page_no, pos) GROUP BY listing""")
def a6_counters(spark, sf):
    return listings.listing_counters(listing_rows(spark, sf), LISTING_MAX_PAGES, LISTING_MAX_OFFERS)


@query("a7_since_bucket", """
SELECT event_id, CASE WHEN d <= 1 THEN '_24_HOURS' WHEN d <= 7 THEN '_7_DAYS' WHEN d <= 15 THEN '_15_DAYS' ELSE 'ANY' END AS bucket
FROM (SELECT event_id, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)) / 86400000000 AS d FROM events)""")
def a7(spark, sf):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id", listings.since_bucket(F.col("ts").cast("timestamp"), now).alias("bucket"))


@query("a9_e3_hydrate", """
SELECT o_orderkey AS id, o_orderstatus AS tenant, max(l_linenumber)::BIGINT AS line,
       arg_max(l_partkey, (l_linenumber, l_partkey)) AS detail FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def a9(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("tenant"))
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.struct("l_linenumber", "l_partkey").alias("pos"),
        F.col("l_linenumber").cast("long").alias("line"), F.col("l_partkey").alias("detail"))
    payload = lines.join(orders, "id").select("tenant", "id", "pos", "line", "detail")
    return listings.hydrate(orders, payload).select("id", "tenant", "line", "detail")


@query("a16_i1_companies_page", "SELECT c_custkey AS id, c_name FROM customer ORDER BY id LIMIT 100 OFFSET 50")
def a16(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name").orderBy("id").offset(50).limit(100)


@query("a17_i2_provider_sources", """
SELECT s_suppkey AS id FROM supplier WHERE s_nationkey < 12 AND s_acctbal >= 0""")
def a17(spark, sf):
    return table(spark, sf, "supplier").filter("s_nationkey < 12 AND s_acctbal >= 0").select(
        F.col("s_suppkey").alias("id"))


# --- provider payloads: documents written as JSON, then read with the declared schema ---


def payload(spark, sf, schema, **fields):
    docs = table(spark, sf, "documents")
    packed = docs.select("source", F.to_json(F.struct(*[F.expr(e).alias(n) for n, e in fields.items()])).alias("j"))
    return packed.select(F.col("source").alias("tenant"), F.from_json("j", schema).alias("p")).select("tenant", "p.*")


@query("a1_h23_marketplace_items", r"""
SELECT doc_id::VARCHAR AS id, 'https://x.test/' || doc_id::VARCHAR AS url, split_part(text, chr(10), 1) AS title,
  source AS company, trim(source) AS company_key, lang AS city, CASE WHEN n_chars > 2000 THEN lang END AS pay
FROM documents WHERE lang <> 'de'""")
def a1(spark, sf):
    rows = payload(
        spark, sf, payloads.MARKETPLACE_ITEM, id="CASE WHEN lang <> 'de' THEN CAST(doc_id AS STRING) END",
        title="split(text, '\\n')[0]", link="concat('https://x.test/', doc_id)", city="lang",
        author="named_struct('id', source, 'name', source)",
        minPay="CASE WHEN n_chars > 2000 THEN named_struct('id', 1, 'value', lang) END")
    return payloads.map_marketplace_items(rows).select(
        "id", "url", "title", F.col("company.name").alias("company"),
        F.col("company.normalizedName").alias("company_key"), F.col("location.city").alias("city"),
        F.col("metadata.salary.min.value").alias("pay"))


@query("a2_h6_marketplace_details", """
SELECT doc_id::VARCHAR AS id, text AS description, CASE WHEN lang = 'fr' THEN 'http://www.' || source || '.test/a'
  ELSE 'https://jobs.infojobs.net' END AS website, CASE WHEN lang = 'fr' THEN source || '.test' END AS domain
FROM documents""")
def a2(spark, sf):
    rows = payload(
        spark, sf, payloads.MARKETPLACE_DETAIL, id="CAST(doc_id AS STRING)", description="text",
        profile="named_struct('id', source, 'name', source, 'corporateWebsiteUrl', ' ', 'websiteUrl', "
                "CASE WHEN lang = 'fr' THEN concat(' http://www.', source, '.test/a') END, "
                "'web', 'https://jobs.infojobs.net')")
    return payloads.map_marketplace_details(rows).select(
        "id", "description", F.col("company.websiteUrl").alias("website"),
        F.col("company.websiteDomain").alias("domain"))


@query("a3_h10_postings", """
SELECT doc_id::VARCHAR AS id, source AS company_name, strftime(epoch_ms(1704067200000 + doc_id * 1001), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS "publishedAt",
  CASE WHEN n_chars > 1000 THEN source ELSE lang END AS category,
  text || chr(10) || chr(10) || lang || ':' || chr(10) || source AS description FROM documents""")
def a3(spark, sf):
    rows = payload(
        spark, sf, payloads.POSTING, id="CAST(doc_id AS STRING)", text="lang",
        createdAt="1704067200000 + doc_id * 1001", description="text", descriptionPlain="''",
        categories="named_struct('department', CASE WHEN n_chars > 1000 THEN source END, 'team', lang)",
        lists="array(named_struct('text', lang, 'content', source), named_struct('text', '', 'content', 'x'))")
    return payloads.map_postings(rows).select("id", "company_name", "publishedAt", "category", "description")


@query("a4_jobs", """
SELECT doc_id::VARCHAR AS id, source AS company_name, CASE WHEN lang = 'en' THEN source ELSE lang END AS category,
  text AS description FROM documents""")
def a4(spark, sf):
    rows = payload(
        spark, sf, payloads.JOB, id="doc_id", title="lang", content="text",
        metadata="array(named_struct('id', 1L, 'name', 'other', 'value', 'x'), named_struct('id', 2L, 'name', "
                 "'Department', 'value', CASE WHEN lang = 'en' THEN to_json(array(source, lang)) ELSE lang END))")
    return payloads.map_jobs(rows).select("id", "company_name", "category", "description")
