"""Discovery, directories, hydration, URL resolution and export as whole flows over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from offerlens.functions import urls
from offerlens.operators import directories
from offerlens.plans import directory_ingest, discovery, sheet_export
from offerlens.session import local_frame
from offerlens.sources import listings
from registry import query
from registry.jobs import METRICS_SQL, SHEETED, exported, sheeted
from registry.pages import ANCHORS_SQL, CAREERS, pages, pages_with_hosts
from registry.views import table

# a page's place on its site by its rank: the front page, two tried paths, one behind a career link, others
PLACE = """CASE r WHEN 1 THEN '' WHEN 2 THEN '/careers' WHEN 3 THEN '/jobs' WHEN 4 THEN '/careers/and' ELSE concat('/p', page_id) END"""
LANGUAGE = (("site", r"(?i)<html lang=\"(es|fr)\""),)


def site_pages(spark, sf):
    host = urls.url_host(F.col("url"))
    ranked = pages(spark, sf).select("page_id", host.alias("host"), F.expr(CAREERS).alias("html"),
                                     F.row_number().over(Window.partitionBy(host).orderBy("page_id")).alias("r"))
    return ranked.withColumn("url", F.concat(F.lit("https://"), "host", F.expr(PLACE)))


def discovered(spark, sf):
    site = site_pages(spark, sf)
    sites = site.groupBy("host").agg(F.min("page_id").alias("company_id")).select("company_id", F.col("host").alias("website_url"))
    return discovery.discover(sites, site.select("url", "html"), LANGUAGE)


DISCOVERY_SQL = f"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '://([^/?#:]+)', 1)) AS host, html,
    regexp_extract(html, '(?i)<html lang="(es|fr)"', 1) AS lang FROM pages),
s AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS r FROM p),
d AS (SELECT min(page_id) AS company_id, host, arg_min(lang, r) FILTER (WHERE lang <> '' AND r < 4) AS direct, min(r) FILTER (WHERE lang <> '' AND r < 4) AS place,
    bool_or(r < 4 AND regexp_matches(html, '<a\\s+[^>]*href="/and"')) AND count(*) FILTER (WHERE r = 4 AND lang <> '') > 0 AS follow,
    max(lang) FILTER (WHERE r = 4) AS behind FROM s GROUP BY host),
found AS (SELECT company_id, CASE WHEN place IS NOT NULL OR follow THEN 'found' ELSE 'not_found' END AS status,
    CASE WHEN place IS NOT NULL OR follow THEN 'site' END AS provider, CASE WHEN place IS NOT NULL THEN direct WHEN follow THEN behind END AS tenant,
    'https://' || host || CASE place WHEN 1 THEN '' WHEN 2 THEN '/careers' WHEN 3 THEN '/jobs' ELSE CASE WHEN follow THEN '/careers/and' END END AS evidence_url FROM d)
"""


@query("k5_j3_j6_discovery", DISCOVERY_SQL + "SELECT * FROM found")
def k5(spark, sf):
    return discovered(spark, sf)


@query("f15_discovery_counters", DISCOVERY_SQL + """SELECT count(*) AS checked, count(*) FILTER (WHERE status = 'found') AS found,
  count(DISTINCT tenant) AS persisted, count(*) FILTER (WHERE status = 'not_found') AS not_found, 0::BIGINT AS error,
  count(tenant) - count(DISTINCT tenant) AS conflict FROM found""")
def f15(spark, sf):
    """A language belongs to the first site that claims it; the other sites' claims are conflicts."""
    results = discovered(spark, sf)
    held = spark.createDataFrame([], "company_id long, provider string, provider_company_id string, url string")
    return discovery.counters(results, discovery.persist(results, held)[1])


@query("a21_listed_companies", ANCHORS_SQL + r""",
t AS (SELECT l.page_id, l.pos, regexp_extract(p.html, '(?i)<html lang="([a-z]+)"', 1) AS source, href[2:] AS word, lower(text) AS name,
    regexp_replace(lower(regexp_extract(l.url, '://([^/?#:]+)', 1)), '^www\.', '') AS own
  FROM links l JOIN pages p USING (page_id) WHERE regexp_matches(href, '^/t[a-z]*$'))
SELECT source, word || '.example.com' AS domain, arg_min(name, (page_id, pos)) AS name FROM t WHERE own <> word || '.example.com' GROUP BY ALL""")
def a21(spark, sf):
    listing = pages_with_hosts(spark, sf).withColumns({
        "source": F.regexp_extract("html", '(?i)<html lang="([a-z]+)"', 1), "page_no": F.col("page_id")})
    return directories.listed_companies(listing, "source").select("source", "domain", "name")


@query("a9_hydration_counters", """
SELECT l_suppkey AS tenant, count(*) AS requested, count(*) FILTER (WHERE o_orderkey IS NULL) AS missed
FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON o_orderkey = l_orderkey GROUP BY 1""")
def a9(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("tenant"), F.col("l_orderkey").alias("id"))
    payload = lines.distinct().join(table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")), "id")
    return listings.hydration_counters(lines, payload)


@query("h5_resolved_links", """
WITH p AS (SELECT page_id, url, regexp_extract(url, '^[^?#]*', 0) AS path, regexp_replace(regexp_extract(url, '^[^?#]*', 0), '[^/]*$', '') AS folder FROM pages)
SELECT page_id, regexp_replace(folder, '([^/:])/[^/]+/$', '\\1/') || 'jobs' AS up, folder || 'a/c?x=..' AS inside, path || '?q=1' AS asked,
  regexp_replace(url, '#.*$', '') AS same, regexp_extract(url, '^[^:]+:', 0) || '//other.test/x' AS other FROM p""")
def h5(spark, sf):
    to = lambda href: urls.resolve_url(F.lit(href), F.col("url"))
    return table(spark, sf, "pages").select("page_id", to("../jobs").alias("up"), to("./a/b/../c?x=..").alias("inside"), to("?q=1").alias("asked"),
                                            to("").alias("same"), to("//OTHER.test/x").alias("other"))


@query("k6_f16_j2_sync_counters", METRICS_SQL.rstrip() + f""", sheet AS ({SHEETED}),
n AS (SELECT count(*) AS companies, count(*) FILTER (WHERE c IS NULL) AS appended, count(c) AS updated FROM export LEFT JOIN sheet ON c = company_id)
SELECT companies, appended, updated, 0::BIGINT AS untouched, companies AS acted, 0::BIGINT AS skipped,
  ceil(appended / 100)::BIGINT AS append_batches, ceil(updated / 50)::BIGINT AS update_batches FROM n""")
def k6(spark, sf):
    cells = [F.lit("old").alias(c) for c in sheet_export.CELLS]
    return sheet_export.counters(sheet_export.sync(exported(spark, sf), sheeted(spark, sf).select("row_index", "company_id", *cells)))


RULES = [("en", "^/t[a-z]*$"), ("de", "^/[a-d][a-z]*$"), ("fr", "^/[e-z][a-z]*$"), ("es", "^/a[a-z]*$")]


def directories_by_language(spark, sf):
    """Each language is a directory with a path rule of its own; a listed page holds a link to a site named by its path."""
    pages_ = pages(spark, sf).withColumns({"source": F.regexp_extract("html", '(?i)<html lang="([a-z]+)"', 1), "host": urls.url_host(F.col("url")), "page_no": F.col("page_id")})
    listing = pages_.withColumns({"url": F.concat(F.lit("https://"), "source", F.lit(".test/list")), "host": F.concat("source", F.lit(".test"))})
    rules = local_frame(spark, [(s, f"{s}.test", r"(?i)<li\b[^>]*>([\s\S]*?)</li>", r"(?i)<a\b[^>]*>([\s\S]*?)</a>", p) for s, p in RULES],
                        "source string, host string, card string, title string, detail_path string")
    entries = directory_ingest.listed_entries(listing, rules)
    # pages of paths that end in e are not there; the others link to the site of the path's first two letters
    word = F.regexp_extract("detail_url", "([a-z]+)$", 1)
    details = entries.select("detail_url", word.alias("w")).distinct().filter("w NOT LIKE '%e'").select(
        F.col("detail_url").alias("url"), F.concat(F.lit('<a href="https://www.'), F.substring("w", 1, 2), F.lit('.example.org/">site</a>')).alias("html"))
    return directory_ingest.ingest_directories(listing, details, rules)


DIRECTORY_SQL = r"""WITH RECURSIVE p AS (SELECT page_id, regexp_extract(html, '(?i)<html lang="([a-z]+)"', 1) AS source,
    regexp_extract_all(html, '(?i)<li\b[^>]*>([\s\S]*?)</li>', 1) AS cards FROM pages),
f AS (SELECT page_id, source, unnest(range(0, len(cards))) AS card_no, cards FROM p),
c AS (SELECT page_id, source, card_no, regexp_extract(cards[card_no + 1], 'href="/([a-z]+)"', 1) AS word,
    trim(regexp_replace(regexp_extract(cards[card_no + 1], '(?i)<a\b[^>]*>([\s\S]*?)</a>', 1), '<[^>]+>', ' ', 'g')) AS name_raw FROM f),
e AS (SELECT source, word, min((page_id, card_no)) AS place, arg_min(name_raw, (page_id, card_no)) AS name_raw FROM c
  WHERE name_raw <> '' AND word <> '' AND regexp_matches('/' || word, CASE source WHEN 'en' THEN '^/t[a-z]*$' WHEN 'de' THEN '^/[a-d][a-z]*$' WHEN 'fr' THEN '^/[e-z][a-z]*$' ELSE '^/a[a-z]*$' END)
  GROUP BY ALL),
o AS (SELECT *, left(word, 2) || '.example.org' AS domain, lower(name_raw) AS name, row_number() OVER (PARTITION BY source ORDER BY place) AS k FROM e WHERE word NOT LIKE '%e'),
fold AS (SELECT source, 0::BIGINT AS k, []::VARCHAR[] AS seen, []::VARCHAR[] AS kept FROM (SELECT DISTINCT source FROM e)
  UNION ALL SELECT fold.source, o.k, CASE WHEN list_has_any(seen, ['d' || o.domain, 'n' || o.name]) THEN seen ELSE seen || ['d' || o.domain, 'n' || o.name] END,
    CASE WHEN list_has_any(seen, ['d' || o.domain, 'n' || o.name]) THEN kept ELSE list_append(kept, o.word) END
  FROM fold JOIN o ON o.source = fold.source AND o.k = fold.k + 1),
won AS (SELECT source, unnest(arg_max(kept, k)) AS word FROM fold GROUP BY source)
"""


@query("k4_a20_directory_companies", DIRECTORY_SQL + "SELECT source, name_raw, name AS normalized_name, domain AS website_domain FROM o JOIN won USING (source, word)")
def k4(spark, sf):
    return directories_by_language(spark, sf)[0].select("source", "name_raw", "normalized_name", "website_domain")


@query("k4_f14_directory_counters", DIRECTORY_SQL + """SELECT source, count(*) AS fetched, count(won.word) AS upserted,
  count(*) FILTER (WHERE won.word IS NULL AND e.word NOT LIKE '%e') AS skipped, count(*) FILTER (WHERE e.word LIKE '%e') AS failed
FROM e LEFT JOIN won USING (source, word) GROUP BY ROLLUP (source)""")
def k4_counters(spark, sf):
    return directories_by_language(spark, sf)[1]
