"""Companies out of directory pages: detail URL rules, first-wins on two keys, details."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.urls import is_excluded_url, normalize_company_name, resolve_url, url_host, url_path, website_domain
from offerlens.operators.extraction import anchors, external_links
from offerlens.operators.numbering import numbered
from offerlens.operators.ordered import first_kept


@dataclass(frozen=True)
class DetailRule:
    """Path shape of a directory's detail pages: fixed leading segments, then so many free ones."""

    prefix: tuple[str, ...]
    free: int = 1
    numeric_last: bool = False


# fixed values: the path shapes of the three known directories
NUMBERED = DetailRule(("startup",), 3, numeric_last=True)
PROJECT = DetailRule(("proyecto",), 1)


def is_detail_url(url: Column, host: Column, rule: DetailRule) -> Column:
    segments = F.filter(F.split(url_path(url), "/"), lambda s: s != "")
    n = len(rule.prefix)
    ok = url_host(url).eqNullSafe(host) & (F.size(segments) == n + rule.free)
    for k, name in enumerate(rule.prefix):
        ok = ok & (F.get(segments, F.lit(k)) == name)
    if rule.numeric_last:
        ok = ok & F.get(segments, F.lit(n + rule.free - 1)).rlike(r"^\d+$")
    return F.coalesce(ok, F.lit(False))


def valid_entries(entries: DataFrame) -> DataFrame:
    """Entries with an identity, a name and a URL."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name) != "", F.lit(False))
    return entries.filter((filled("website_domain") | filled("normalized_name")) & filled("name_raw") & filled("website_url"))


def first_wins(entries: DataFrame) -> DataFrame:
    """The entries of (source, seq, domain, name, ...) that an ordered read keeps.

    An entry is kept unless an earlier kept one of its source has its domain or
    its name. Entries connected through domains and names are folded together
    (``ordered.first_kept``), however long their chains; nothing is gathered per source.
    """
    entries = entries.filter("domain IS NOT NULL AND name IS NOT NULL")
    key = ["source", "domain", "name"]
    placed = numbered(entries.groupBy(*key).agg(F.min("seq").alias("seq")), "source", "seq", "domain", "name", name="item")
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    keys = F.array(F.concat_ws("\n", F.lit("d"), source, "domain"), F.concat_ws("\n", F.lit("n"), source, "name"))
    claims = placed.select("item", F.explode(keys).alias("key"), F.lit(True).alias("holds"), F.lit(True).alias("asks"))
    winners = placed.join(first_kept(claims), "item", "left_semi").select(*key, "seq")
    return entries.join(winners, [*key, "seq"], "left_semi").dropDuplicates(["source", "seq"])


def listed_companies(pages: DataFrame, source: str) -> DataFrame:
    """Companies straight from listing pages: external links, first-wins on domain and name.

    ``source`` names the key column of the directory; pages are read in the order of ``page_no``.
    """
    links = external_links(pages, source, "page_no").filter("name <> ''")
    return first_wins(links.select(
        F.col(source).alias("source"), F.struct("page_no", "pos").alias("seq"), "domain", "name",
        F.col("text").alias("name_raw"), F.col("link").alias("website_url")))


def detail_websites(listing: DataFrame, pages: DataFrame, base_host: Column, rejected: tuple[str, ...] = ()) -> DataFrame:
    """Candidates (source, seq, domain, name, ...) from the detail pages of a listing.

    ``listing``: source, entry_no, name_raw, detail_url. A listed name comes
    with every allowed website of its page, in order; first-wins then leaves
    one website to a name and one name to a website. A page that is not there
    gives nothing.
    """
    found = listing.join(pages.select(F.col("url").alias("detail_url"), "html"), "detail_url")
    links = anchors(found.withColumn("url", F.col("detail_url")), "source", "entry_no", "name_raw").withColumn(
        "link", resolve_url(F.col("href"), F.col("url")))
    domain = website_domain(F.col("link"))
    allowed = ~is_excluded_url(F.col("link"), F.coalesce(base_host, F.lit("")))
    if rejected:
        allowed = allowed & ~domain.isin(*rejected)
    return first_wins(links.filter(allowed).select(
        "source", F.struct("entry_no", "pos").alias("seq"), domain.alias("domain"),
        F.nullif(normalize_company_name(F.col("name_raw")), F.lit("")).alias("name"), "name_raw", F.col("link").alias("website_url")))
