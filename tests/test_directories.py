import random

from pyspark.sql import functions as F

from offerlens.operators import directories
from offerlens.plans import discovery


def test_first_wins_against_an_ordered_read(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), k, f"d{rng.randrange(30)}", f"n{rng.randrange(30)}") for k in range(300)] + [("a", 1000, None, "x"), ("a", 1001, "y", None)]
    got = {(r.source, r.seq) for r in directories.first_wins(spark.createDataFrame(rows, "source string, seq int, domain string, name string")).collect()}
    seen, want = set(), set()
    for s, k, d, n in sorted(rows, key=lambda r: r[1]):
        if d and n and not {(s, d), (s, n)} & seen:
            seen |= {(s, d), (s, n)}
            want.add((s, k))
    assert got == want
    assert directories.first_wins(spark.createDataFrame([], "source string, seq int, domain string, name string")).count() == 0


def test_detail_urls(spark):
    cases = {("https://h.es/startup/bcn/acme/12/", 0): True, ("https://h.es/startup/bcn/acme/x", 0): False, ("https://h.es/startup/bcn/acme/12/z", 0): False,
             ("https://o.es/startup/bcn/acme/12", 0): False, ("https://h.es/proyecto/acme", 1): True, ("https://h.es/proyecto/", 1): False, ("https://H.es/proyecto/a?x=1", 1): True}
    df = spark.createDataFrame([(*k, v) for k, v in cases.items()], "url string, rule int, want boolean")
    for k, rule in enumerate((directories.NUMBERED, directories.PROJECT)):
        for r in df.filter(F.col("rule") == k).select("url", "want", directories.is_detail_url(F.col("url"), F.lit("h.es"), rule).alias("got")).collect():
            assert r.got == r.want, r.url


def test_listing_and_details(spark):
    link = '<a href="{}">{}</a>'.format
    pages = spark.createDataFrame([
        ("s", 0, "https://dir.es/list", link("https://a.com/x", "Acme") + link("https://www.a.com", "Other") + link("https://b.com", "ACME, S.L.") + link("https://c.com", "Cee") + link("/local", "L")),
        ("s", 1, "https://dir.es/list2", link("https://c.com/2", "Dee") + link("https://linkedin.com/q", "Q"))], "source string, page_no int, url string, html string")
    assert {(r.domain, r.name_raw) for r in directories.listed_companies(pages, "source").collect()} == {("a.com", "Acme"), ("c.com", "Cee")}
    listing = spark.createDataFrame([("s", 0, "Acme", "https://dir.es/1"), ("s", 1, "Bee", "https://dir.es/2"), ("s", 2, "Gone", "https://dir.es/3")], "source string, entry_no int, name_raw string, detail_url string")
    details = spark.createDataFrame([("https://dir.es/1", link("https://whatsapp.com/s", "share") + link("https://a.com", "web") + link("https://a2.com", "more")),
                                     ("https://dir.es/2", link("https://a.com", "partner") + link("https://bee.com", "web"))], "url string, html string")
    got = {(r.name_raw, r.domain) for r in directories.detail_websites(listing, details, F.lit("dir.es"), ("whatsapp.com",)).collect()}
    assert got == {("Acme", "a.com"), ("Bee", "bee.com")}


def test_discovery_in_order_and_one_step(spark):
    sites = spark.createDataFrame([(1, "http://A.com/"), (2, "b.com"), (3, "https://c.com"), (4, " "), (5, "https://e.com")], "company_id long, website_url string")
    pages = spark.createDataFrame([
        ("https://a.com", "nothing"), ("https://a.com/careers", "https://boards.greenhouse.io/later"), ("https://a.com/jobs", "https://jobs.lever.co/too_late"),
        ("https://b.com", '<a href="/careers/team"><img></a><a href="/about">x</a><a href="/careers">y</a>'), ("https://b.com/careers/team", "see https://jobs.lever.co/bee and https://boards.greenhouse.io/no"),
        ("https://c.com", '<a href="/careers/none">x</a>'), ("https://e.com/jobs", "https://jobs.lever.co/bee")], "url string, html string")
    results = discovery.discover(sites, pages)
    got = {r.company_id: (r.status, r.provider, r.tenant) for r in results.collect()}
    assert got == {1: ("found", "greenhouse", "later"), 2: ("found", "lever", "bee"), 3: ("not_found", None, None), 4: ("error", None, None), 5: ("found", "lever", "bee")}
    held = spark.createDataFrame([(9, "greenhouse", "later", "u")], "company_id long, provider string, provider_company_id string, url string")
    links, refused = discovery.persist(results, held)
    assert {r.company_id for r in links.collect()} == {9, 2} and {r.company_id for r in refused.collect()} == {1, 5}
    assert tuple(discovery.counters(results, refused).first()) == (5, 3, 1, 1, 1, 2)
