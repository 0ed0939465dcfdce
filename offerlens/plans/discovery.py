"""Hiring-platform discovery over a table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.constants import ATS_PATTERNS
from offerlens.functions.urls import candidate_urls, is_career_link, normalize_website_url, resolve_url, url_host
from offerlens.operators.company_sources import merge_by_company
from offerlens.operators.extraction import detect_tenant, hrefs


def discover(sites: DataFrame, pages: DataFrame, patterns: tuple = ATS_PATTERNS) -> DataFrame:
    """company_id, status (found, not_found, error), provider, tenant, evidence_url.

    ``sites``: company_id, website_url; ``pages``: url, html. The candidate
    paths of a site are looked up in order; the first page with a platform
    decides. Without one, the career links of the pages that were there are
    followed one step, all of them, in the order of page and link; links that
    were candidates are not tried again.
    """
    based = sites.select("company_id", normalize_website_url(F.col("website_url")).alias("base"))
    tried = based.filter("base IS NOT NULL").select("company_id", "base", F.posexplode(candidate_urls(F.col("base"))).alias("candidate_no", "candidate"))
    read = pages.select(F.col("url").alias("page_url"), "html")
    fetched = tried.join(read, F.col("candidate") == F.col("page_url"))
    direct = fetched.select("company_id", F.struct(F.lit(0).alias("step"), "candidate_no", F.lit(0).alias("pos")).alias("at"),
                            detect_tenant(F.col("html"), patterns).alias("found"), F.col("candidate").alias("evidence_url"))
    links = hrefs(fetched.select("company_id", "candidate_no", "base", F.col("candidate").alias("url"), "html"), "company_id", "candidate_no", "base")
    links = links.withColumn("link", resolve_url(F.col("href"), F.col("url"))).filter(
        is_career_link(F.col("href"), F.col("link"), url_host(F.col("url"))) & ~F.array_contains(candidate_urls(F.col("base")), F.col("link")))
    first = links.groupBy("company_id", "link").agg(F.min(F.struct(F.lit(1).alias("step"), "candidate_no", "pos")).alias("at"))
    followed = first.join(read, F.col("link") == F.col("page_url")).select(
        "company_id", "at", detect_tenant(F.col("html"), patterns).alias("found"), F.col("link").alias("evidence_url"))
    best = direct.unionByName(followed).filter("found IS NOT NULL").groupBy("company_id").agg(
        F.min_by(F.struct("found.provider", "found.tenant", "evidence_url"), "at").alias("b"))
    return based.join(best, "company_id", "left").select(
        "company_id", F.when(F.col("base").isNull(), "error").when(F.col("b").isNotNull(), "found").otherwise("not_found").alias("status"),
        "b.provider", "b.tenant", "b.evidence_url")


def persist(results: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Provider links after the finds, and the finds whose tenant another company holds."""
    finds = results.filter("status = 'found'").select(
        "company_id", "provider", F.col("tenant").alias("provider_company_id"), F.col("evidence_url").alias("url"), F.col("company_id").alias("seq"))
    return merge_by_company(links, finds)


def counters(results: DataFrame, refused: DataFrame) -> DataFrame:
    """checked, found, persisted, not_found, error, conflict of a batch."""
    marked = results.join(refused.select("company_id", F.lit(True).alias("refused")), "company_id", "left")
    found = F.col("status") == "found"
    return marked.agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(found).alias("found"), F.count_if(found & F.col("refused").isNull()).alias("persisted"),
        F.count_if(F.col("status") == "not_found").alias("not_found"), F.count_if(F.col("status") == "error").alias("error"),
        F.count_if(F.col("refused").isNotNull()).alias("conflict"))
