"""Directory ingest driven by a table of rules: listing cards, their detail pages, companies and counters in one plan.

A rule is a row: source, host, card (its first group is the card's HTML), title (its first group is the name) and detail_path (what a detail
page's path looks like), all regular expressions but the first two. A new directory is a new row; all sources run together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.constants import DIRECTORY_RULES
from offerlens.functions.urls import canonical_detail_url, resolve_url, url_host, url_path
from offerlens.operators.directories import detail_websites, valid_entries
from offerlens.operators.extraction import HREF, strip_tags
from offerlens.operators.runs import outcome_counters
from offerlens.session import local_frame, materialized


def known_rules(spark: SparkSession) -> DataFrame:
    """The rules of the three known directories."""
    return local_frame(spark, list(DIRECTORY_RULES), "source string, host string, card string, title string, detail_path string")


def listed_entries(listing: DataFrame, rules: DataFrame) -> DataFrame:
    """source, entry_no, name_raw, detail_url: per card its title and first link to a detail page of the rule's host.

    ``listing``: source, page_no, url, html. Cards without a title are skipped; a detail page that several cards list belongs to the first.
    """
    cards = listing.select("source", "page_no", "url", "html").join(rules, "source").select(
        "source", "host", "title", "detail_path", "page_no", "url", F.posexplode(F.regexp_extract_all("html", F.col("card"), F.lit(1))).alias("card_no", "body"))
    named = cards.withColumn("name_raw", strip_tags(F.expr("regexp_extract(body, title, 1)"))).filter("name_raw <> ''")
    links = named.select("source", "host", "detail_path", "page_no", "card_no", "name_raw", "url",
                         F.posexplode(F.regexp_extract_all("body", F.lit(HREF), F.lit(1))).alias("link_no", "href"))
    found = links.withColumn("detail_url", canonical_detail_url(resolve_url(F.col("href"), F.col("url"))))
    good = found.filter(url_host(F.col("detail_url")).eqNullSafe(F.lower("host")) & F.regexp(url_path(F.col("detail_url")), F.col("detail_path")))
    first = good.groupBy("source", "page_no", "card_no").agg(F.min_by(F.struct("name_raw", "detail_url"), "link_no").alias("c"))
    return first.groupBy("source", "c.detail_url").agg(F.min(F.struct("page_no", "card_no")).alias("entry_no"), F.min_by("c.name_raw", F.struct("page_no", "card_no")).alias("name_raw"))


def ingest_directories(listing: DataFrame, pages: DataFrame, rules: DataFrame, rejected: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(companies, counters). Companies: source, name_raw, normalized_name, website_url, website_domain, first on both keys in their source.

    ``pages``: url, html of the detail pages that were fetched. Counters per source and in total (null): an entry is upserted if its
    page gave a valid company, failed if its page is not there, else skipped.
    """
    entries = materialized(listed_entries(listing, rules))
    found = detail_websites(entries, pages, url_host(F.col("url")), rejected)
    companies = materialized(valid_entries(found.select(
        "source", F.col("seq.entry_no").alias("entry_no"), "name_raw", F.col("name").alias("normalized_name"), "website_url", F.col("domain").alias("website_domain"))))
    there = pages.select(F.col("url").alias("detail_url"), F.lit(True).alias("there")).distinct()
    marked = entries.join(companies.select("source", "entry_no", F.lit(True).alias("kept")), ["source", "entry_no"], "left").join(there, "detail_url", "left")
    outcome = F.when(F.col("kept"), "upserted").when(F.col("there").isNull(), "failed").otherwise("skipped")
    return companies.drop("entry_no"), outcome_counters(marked.withColumn("outcome", outcome), "source")
