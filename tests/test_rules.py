"""Rules with fixed examples."""

import pytest
from pyspark.sql import functions as F

from offerlens.functions import urls
from offerlens.operators import company_sources, dictionary, extraction, feedback, gates, matching, merges, runs, scoring
from offerlens.sources import listings


def values(spark, fn, cases, schema="v string"):
    rows = [(k,) if not isinstance(k, tuple) else k for k in cases]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in df.select("i", fn(df).alias("out")).orderBy("i").select("out").collect()]


@pytest.mark.parametrize("fn,cases", [
    (urls.normalize_company_name, {"  Ácme   Corp, S.L.": "acme corp", "ACME SLU": "acme", "Acme, S.A.": "acme", "Foo s. l.": "foo", "Sol": "sol"}),
    (urls.website_domain, {"https://www.Example.COM/a": "example.com", "http://user@a.b.co:80/x": "a.b.co", "https://localhost/x": None, "no url": None}),
    (urls.normalize_website_url, {" http://Example.COM/A/ ": "https://example.com/A", "www.Foo.es": "https://www.foo.es", "HTTPS://x.y?Q=A": "https://x.y?Q=A"}),
    (urls.canonical_detail_url, {"https://a.b/c/?x=1#y": "https://a.b/c", "https://a.b/c//": "https://a.b/c"}),
    (urls.is_absolute_url, {"https://a.b": True, " mailto:x@y ": True, "/a": False, "": False, None: False, "http://": False}),
])
def test_url_rules(spark, fn, cases):
    assert values(spark, lambda d: fn(d.v), cases) == list(cases.values())


def test_all_career_paths_are_candidates(spark):
    got = values(spark, lambda d: urls.candidate_urls(d.v), ["https://a.b"])[0]
    assert len(got) == len(set(got)) == 11 and got[-1] == "https://a.b/job-openings"


def test_links_need_no_text_and_may_be_long(spark):
    long = "/careers/" + "x" * 3000
    html = f'<a class="i" href="/careers"><img src="x"></a> <a href="/jobs">two\nlines</a> <a href="{long}">t</a> <a href="/about">a</a> <a href="https://other.test/jobs">o</a>'
    pages = spark.createDataFrame([(1, "https://a.test/x", html)], "page_id int, url string, html string")
    got = {r.link for r in extraction.career_links(pages, "page_id").collect()}
    assert got == {"https://a.test/careers", "https://a.test/jobs", "https://a.test" + long}
    assert len(extraction.career_links(pages, "page_id", longest=300).collect()) == 2
    assert [r.href for r in extraction.anchors(pages, "page_id").orderBy("pos").collect()] == [long, "/about", "https://other.test/jobs"]


def small_dictionary(spark, ordinals, aliases=("forex",)):
    categories = spark.createDataFrame([(c, c, 3) for c, _ in ordinals], "id string, name string, tier int")
    keywords = spark.createDataFrame([(o, f"k{o}", c, c, list(aliases)) for c, o in ordinals], "ordinal int, id string, category_id string, canonical string, aliases array<string>")
    phrases = spark.createDataFrame([], "ordinal int, id string, phrase string, tier int")
    return dictionary.compile_dictionary(dictionary.Dictionary(categories, keywords, phrases))


def test_dictionary_order_holds_for_large_ordinals(spark):
    offers = spark.createDataFrame([(1, "forex", "x")], "offer_id long, title string, description string")
    for first, second in ((2, 200_000), (200_000, 3_000_000)):
        patterns = small_dictionary(spark, [("cat_b_x", second), ("cat_a_y", first)])
        hits = matching.match_offers(offers, patterns, "offer_id")
        assert scoring.score_offers(hits, offers, "offer_id").first().top_category_id == "cat_a_y"


def test_many_aliases_keep_their_keyword(spark):
    aliases = tuple(f"alias{k}" for k in range(1500))
    patterns = small_dictionary(spark, [("cat_a", 1), ("cat_b", 2)], aliases)
    offers = spark.createDataFrame([(1, "alias1400 alias3", "")], "offer_id long, title string, description string")
    order = [r.dict_id for r in matching.match_offers(offers, patterns, "offer_id").orderBy("ordinal").collect()]
    assert order == ["k1", "k2", "k1", "k2"]


def test_paged_listing_stops_at_an_empty_page(spark):
    rows = [("a", p, k, 100 * p + k if (p, k) != (1, 1) else None) for p in (0, 1, 3) for k in range(3)] + [("b", 1, 0, 7)]
    df = spark.createDataFrame(rows, "listing string, page_no long, pos long, offer_id long")
    assert sorted(r.offer_id for r in listings.paged_listing(df).collect()) == [0, 1, 2, 100, 102]
    assert sorted(r.offer_id for r in listings.paged_listing(df, max_offers=4).collect()) == [0, 1, 2, 100]
    assert sorted(r.offer_id for r in listings.paged_listing(df, max_pages=1).collect()) == [0, 1, 2]
    [row] = listings.listing_counters(df, 1, 100).collect()
    assert tuple(row) == ("a", 1, 3, "maxPages")


def test_taken_provider_ids_are_refused(spark):
    schema = "company_id long, provider string, provider_company_id string, url string"
    old = spark.createDataFrame([(1, "p", "x", "u1"), (2, "p", "y", "u2")], schema)
    new = spark.createDataFrame([(2, "p", "x", "new", 1), (3, "p", "z", "u3", 2), (4, "p", "z", "u4", 3), (1, "p", "x", None, 4)], schema + ", seq long")
    links, refused = company_sources.merge_by_company(old, new)
    assert sorted(map(tuple, links.collect())) == [(1, "p", "x", None), (2, "p", "y", "u2"), (3, "p", "z", "u3")]
    assert sorted(r.company_id for r in refused.collect()) == [2, 4]


def test_insert_ignore_keeps_whole_rows(spark):
    old = spark.createDataFrame([(1, None, 5)], "company long, note string, n int")
    new = spark.createDataFrame([(1, "", 6), (1, "a", 8), (1, "a", 7), (2, None, 9)], "company long, note string, n int")
    got = merges.insert_ignore(old, new, ["company", "note"])
    assert got.dtypes == new.dtypes and sorted(map(tuple, got.collect())) == [(1, "a", 7), (2, None, 9)]


def test_blank_sheet_rows_only_count_in_all(spark):
    rows = [(2, "1", "accepted"), (3, "1", "REJECTED"), (4, "", None), (5, None, ""), (6, "x", "accepted"), (7, "3", "maybe")]
    got = feedback.read_counters(spark.createDataFrame(rows, "row_index int, c0 string, c2 string")).first()
    assert tuple(got) == (6, 1, 2, 1)


def test_query_key_keeps_types(spark):
    df = spark.createDataFrame([(5, True, "a", None)], "b int, a boolean, c string, d string")
    key = df.select(runs.query_key(F.lit("cl"), F.lit("n"), F.struct("*"), ("b", "a", "c", "d"))).first()[0]
    import hashlib
    assert key == "cl:n:" + hashlib.sha256(b'{"a":true,"b":5,"c":"a"}').hexdigest()[:12]


def test_gates_in_order(spark):
    companies = spark.createDataFrame([(1, "PENDING"), (2, "REJECTED")], "id long, resolution string")
    rows = [(1, " ", "lever", "", 2), (2, "https://a", "lever", " ", 2), (3, "https://a", "infojobs", "", None), (4, "https://a", "x", "d", 2), (5, "https://a", "x", "d", 1)]
    offers = spark.createDataFrame(rows, "offer_id long, provider_url string, provider string, description string, company_id long")
    got = {r.offer_id: r.outcome for r in gates.gate_offers(offers, companies).collect()}
    assert got == {1: "missing_provider_url", 2: "missing_description", 3: "company_unidentifiable", 4: "company_resolved", 5: None}
