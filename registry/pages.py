"""URL and HTML queries over pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.functions import urls
from offerlens.operators import extraction
from registry import query
from registry.views import spread, table

TENANT_PATTERNS = (("nav", r"(?i)<a href=\"/(the[a-z]*)\""), ("lang", r"(?i)<html lang=\"([a-z]+)\""))


def pages(spark, sf):
    return spread(table(spark, sf, "pages"), "page_id")


ANCHORS_SQL = r"""WITH raw AS (SELECT page_id, url,
    regexp_extract_all(html, '(?i)<a\s+[^>]*href=["'']([^"'']+)["''][^>]*>(.*?)</a>', 1) AS hs,
    regexp_extract_all(html, '(?i)<a\s+[^>]*href=["'']([^"'']+)["''][^>]*>(.*?)</a>', 2) AS ts FROM pages),
flat AS (SELECT page_id, url, unnest(range(0, len(hs))) AS pos, hs, ts FROM raw),
anchors AS (SELECT page_id, url, pos, trim(hs[pos + 1]) AS href,
    trim(regexp_replace(ts[pos + 1], '<[^>]+>', '', 'g')) AS text FROM flat),
links AS (SELECT *, regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) || href AS link FROM anchors
    WHERE href <> '' AND text <> '')
"""


@query("h11_anchors", ANCHORS_SQL + "SELECT page_id, pos, href, text FROM links")
def h11(spark, sf):
    return extraction.anchors(pages(spark, sf), "page_id").select(
        "page_id", F.col("pos").cast("long").alias("pos"), "href", "text")


@query("h12_strip_tags", r"""
SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages""")
def h12(spark, sf):
    return pages(spark, sf).select("page_id", extraction.strip_tags(F.col("html")).alias("text"))


@query("h4_h5_website_domain", """
SELECT page_id, regexp_replace(lower(regexp_extract(url, '://([^/?#:]+)', 1)), '^www\\.', '') AS domain FROM pages""")
def h4(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.website_domain(F.col("url")).alias("domain"))


@query("h7_normalize_website_url", """
SELECT page_id, regexp_replace(regexp_replace(url, '^http://', 'https://'), '/$', '') AS url FROM pages""")
def h7(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.normalize_website_url(F.col("url")).alias("url"))


@query("h8_candidate_urls", """
WITH b AS (SELECT DISTINCT 'https://' || regexp_extract(url, '://([^/?#:]+)', 1) AS base FROM pages)
SELECT base, base || unnest(['', '/careers', '/jobs', '/join-us', '/work-with-us', '/careers/jobs', '/jobs/',
  '/empleo', '/trabaja-con-nosotros', '/job-opportunities', '/job-openings']) AS candidate FROM b""")
def h8(spark, sf):
    base = table(spark, sf, "pages").select(
        F.concat(F.lit("https://"), urls.url_host(F.col("url"))).alias("base")).distinct()
    return base.select("base", F.explode(urls.candidate_urls(F.col("base"))).alias("candidate"))


@query("h9_canonical_detail_url", """
SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS url FROM pages""")
def h9(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.canonical_detail_url(F.col("url")).alias("url"))


@query("h3_company_name", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(trim(split_part(text, chr(10), 1)))), '\s+', ' ', 'g'),
  '[,\s]+(s\.?\s?l\.?|s\.?\s?l\.?\s?u\.?|s\.?\s?a\.?)$', '')) AS name FROM documents""")
def h3(spark, sf):
    return table(spark, sf, "documents").select("doc_id", urls.normalize_company_name(
        F.get(F.split("text", "\n"), F.lit(0))).alias("name"))


@query("h13_tenant_detection", """
SELECT page_id, CASE WHEN regexp_matches(html, '(?i)<a href="/(the[a-z]*)"') THEN 'nav' ELSE 'lang' END AS provider,
  CASE WHEN regexp_matches(html, '(?i)<a href="/(the[a-z]*)"') THEN regexp_extract(html, '(?i)<a href="/(the[a-z]*)"', 1)
       ELSE regexp_extract(html, '(?i)<html lang="([a-z]+)"', 1) END AS tenant FROM pages""")
def h13(spark, sf):
    return pages(spark, sf).select(
        "page_id", extraction.detect_tenant(F.col("html"), TENANT_PATTERNS).alias("d")).select("page_id", "d.*")


ABSOLUTE = "regexp_replace(html, 'href=\"/(t[a-z]*)\"', 'href=\"https://www.$1.example.com/\"')"


def pages_with_hosts(spark, sf):
    """Pages whose rooted links that begin with t point to a host of their own."""
    return pages(spark, sf).withColumn("html", F.expr(ABSOLUTE))


@query("a22_c6_external_candidates", """
SELECT page_id, regexp_matches(html, '<a\\s+[^>]*href="/t[a-z]*"[^>]*>[^<]*[^<\\s][^<]*</a>') AS has_external FROM pages""")
def a22(spark, sf):
    return extraction.has_external_candidates(pages_with_hosts(spark, sf), "page_id")


@query("a19_listing_cards", ANCHORS_SQL + """
SELECT page_id, regexp_replace(link, '/+$', '') AS detail_url, arg_min(text, pos) AS name, min(pos) AS card_no
FROM links WHERE regexp_matches(link, '^[^:]+://[^/]+/[a-z]+$') GROUP BY ALL""")
def a19(spark, sf):
    return extraction.listing_cards(
        pages(spark, sf), r"(?i)<li\b[^>]*>([\s\S]*?)</li>", r"(?i)<a\b[^>]*>([\s\S]*?)</a>",
        F.col("detail_url").rlike("^[^:]+://[^/]+/[a-z]+$"), "page_id",
    ).withColumn("card_no", F.col("card_no").cast("long"))


CAREERS = "regexp_replace(html, 'href=\"/(an[a-z]*|de[a-z]*)\"', 'href=\"/careers/$1\"')"


@query("c9_career_links", r"""
WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\s+[^>]*href="/(an[a-z]*|de[a-z]*)"', 1)) AS tail FROM pages)
SELECT DISTINCT page_id, regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) || '/careers/' || tail AS link FROM h""")
def c9(spark, sf):
    """Rooted links that begin with an or de are moved below /careers."""
    return extraction.career_links(pages(spark, sf).withColumn("html", F.expr(CAREERS)), "page_id")
