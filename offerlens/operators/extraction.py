"""Anchors, platform tenants, listing cards and companies out of HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.constants import ATS_PATTERNS
from offerlens.functions.text import collapse_space, trim_space
from offerlens.functions.urls import (
    is_career_link,
    is_excluded_url,
    normalize_company_name,
    resolve_url,
    url_host,
    website_domain,
)

# fixed values: how an anchor with a text, and how any link is recognized
ANCHOR = r"(?i)<a\s+[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
HREF = r"(?i)<a\s+[^>]*href=[\"']([^\"']+)[\"'][^>]*>"


def strip_tags(html: Column) -> Column:
    return trim_space(collapse_space(F.regexp_replace(html, "<[^>]+>", " ")))


def anchors(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, url, pos, href, text) of anchors with both parts non-empty.

    Whole anchors are cut out in one pass over the page; their parts are read
    from the short pieces.
    """
    whole = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))
    return pages.select(*keys, "url", F.posexplode(whole).alias("pos", "a")).select(
        *keys, "url", "pos", trim_space(F.regexp_extract("a", ANCHOR, 1)).alias("href"),
        trim_space(F.regexp_replace(F.regexp_extract("a", ANCHOR, 2), "<[^>]+>", "")).alias("text"),
    ).filter("href <> '' AND text <> ''")


def hrefs(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, url, pos, href) of every link, whatever it encloses."""
    return pages.select(*keys, "url", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("pos", "href")).select(
        *keys, "url", "pos", trim_space(F.col("href")).alias("href")).filter("href <> ''")


def career_links(pages: DataFrame, *keys: str, longest: int | None = None) -> DataFrame:
    """(keys, link): distinct links of a page that look like a way to its jobs."""
    links = hrefs(pages, *keys).withColumn("link", resolve_url(F.col("href"), F.col("url")))
    return links.filter(is_career_link(F.col("href"), F.col("link"), url_host(F.col("url")), longest)).select(*keys, "link").distinct()


def detect_tenant(html: Column, patterns: tuple = ATS_PATTERNS) -> Column:
    """First matching pattern in priority order: struct(provider, tenant)."""
    options = [
        F.when(html.rlike(p), F.struct(
            F.lit(provider).alias("provider"), F.regexp_extract(html, p, 1).alias("tenant")))
        for provider, p in patterns
    ]
    return F.coalesce(*options)


def external_links(pages: DataFrame, *keys: str) -> DataFrame:
    base = website_domain(F.col("url"))
    links = anchors(pages, *keys).withColumn("link", resolve_url(F.col("href"), F.col("url")))
    return links.filter(~is_excluded_url(F.col("link"), F.coalesce(base, F.lit("")))).withColumns({
        "domain": website_domain(F.col("link")), "name": normalize_company_name(F.col("text"))})


def has_external_candidates(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, has_external): whether a page has an anchor that ``external_links`` keeps; one scan, no join."""
    base = F.coalesce(website_domain(F.col("url")), F.lit(""))

    def external(anchor: Column) -> Column:
        href = trim_space(F.regexp_extract(anchor, ANCHOR, 1))
        text = trim_space(F.regexp_replace(F.regexp_extract(anchor, ANCHOR, 2), "<[^>]+>", ""))
        return (href != "") & (text != "") & ~is_excluded_url(resolve_url(href, F.col("url")), base)

    whole = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))
    return pages.select(*keys, F.coalesce(F.exists(whole, external), F.lit(False)).alias("has_external"))


def listing_cards(pages: DataFrame, card: str, title: str, is_detail: Column, *keys: str) -> DataFrame:
    """Cards of listing pages: title text and the first valid detail link.

    ``is_detail`` tests the column ``detail_url`` (already canonical). A
    detail URL listed by several cards belongs to the first one.
    """
    cards = pages.select(
        *keys, "url", F.posexplode(F.regexp_extract_all("html", F.lit(card), F.lit(1))).alias("card_no", "card"))
    named = cards.withColumn("name", strip_tags(F.regexp_extract("card", title, 1))).filter("name <> ''")
    href = F.regexp_extract_all("card", F.lit(HREF), F.lit(1))
    links = named.select(*keys, "url", "card_no", "name", F.posexplode(href).alias("link_no", "href"))
    links = links.withColumn("detail_url", F.regexp_replace(F.regexp_replace(
        resolve_url(F.col("href"), F.col("url")), r"[?#].*$", ""), r"/+$", "")).filter(is_detail)
    first = links.groupBy(*keys, "card_no").agg(
        F.min_by(F.struct("name", "detail_url"), "link_no").alias("c")).select(*keys, "card_no", "c.*")
    return first.groupBy(*keys, "detail_url").agg(
        F.min_by("name", "card_no").alias("name"), F.min("card_no").alias("card_no"))

