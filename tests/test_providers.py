import json

import pytest
from pyspark.sql import functions as F

from offerlens.functions import urls
from offerlens.plans import providers, sheet_export
from tests.test_rules import values


def test_search_responses_good_broken_and_empty(spark, tmp_path):
    offer = lambda i, **k: {"id": i, "title": f"T{i}", "link": f"https://x/{i}", "author": {"id": "7", "name": "Ácme S.L."}, "salaryMin": {"id": 1, "value": "10"}, **k}
    for name, text in {
        "q1/a.json": json.dumps({"currentPage": 2, "totalPages": 2, "offers": [offer("c")]}, indent=2),
        "q1/b.json": json.dumps({"currentPage": 1, "totalPages": 2, "offers": [offer("a"), offer(""), {"title": "no id"}, offer("b", title=None)]}, indent=2),
        "q2/a.json": '{"currentPage": 1, "offers": [',
        "q3/a.json": json.dumps({"currentPage": 1, "totalPages": 0, "offers": []}),
    }.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    responses = providers.read_responses(spark, str(tmp_path))
    offers, counts = providers.marketplace_offers(responses)
    got = offers.orderBy("seq").collect()
    assert [(r.seq, r.provider_offer_id, r.title) for r in got] == [(0, "a", "Ta"), (1, "b", ""), (2, "c", "Tc")]
    assert got[0].normalized_name == "acme" and got[0].provider_company_id == "7" and json.loads(got[0].metadata_json)["salary"]["min"]["value"] == "10"
    assert got[0].description is None and got[0].known_company_id is None
    assert sorted(map(tuple, counts.collect())) == [("q1", 2, 0, 2), ("q2", 1, 1, 0), ("q3", 1, 0, 0)]
    assert [r.provider_offer_id for r in providers.marketplace_offers(responses, max_pages=1)[0].orderBy("seq").collect()] == ["a", "b"]


def test_tenants_with_missing_details_keep_the_order_of_requests(spark):
    sources = spark.createDataFrame([(5, "lever", "acme", None), (2, "lever", "bee", False), (3, "lever", "hid", True), (4, "lever", None, None), (1, "greenhouse", "gh", None)],
                                    "company_id long, provider string, provider_company_id string, hidden boolean")
    requested = spark.createDataFrame([("acme", 0, "z"), ("acme", 1, "a"), ("acme", 2, "gone"), ("bee", 0, "q"), ("hid", 0, "h"), ("other", 0, "o")], "tenant string, request_no int, id string")
    schema = ("tenant string, pos int, id string, text string, hostedUrl string, createdAt bigint, categories struct<commitment:string,department:string,location:string,team:string>, "
              "description string, descriptionPlain string, lists array<struct<text:string,content:string>>, additional string, additionalPlain string")
    row = lambda t, p, i, text: (t, p, i, text, f"https://x/{i}", 0, None, None, f"plain {i}", None, None, None)
    payload = spark.createDataFrame([row("acme", 0, "a", "first"), row("acme", 1, "z", "Z"), row("acme", 2, "a", "last"), row("hid", 0, "h", "H"), row("bee", 0, "other", "x")], schema)
    offers, counts = providers.tenant_offers(sources, "lever", requested, payload)
    assert [(r.seq, r.provider, r.provider_offer_id, r.title, r.known_company_id, r.description) for r in offers.orderBy("seq").collect()] == [
        (0, "lever", "z", "Z", 5, "plain z"), (1, "lever", "a", "last", 5, "plain a")]
    assert sorted(map(tuple, counts.collect())) == [("acme", 3, 1), ("bee", 1, 1)]
    assert providers.tenant_offers(sources, "lever", requested, payload, limit=1)[0].count() == 0  # only the first company, bee


@pytest.mark.parametrize("href,base,want", [
    ("../x", "https://a.b/c/d/e", "https://a.b/c/x"), ("./x/./y/../z", "https://a.b/c/d", "https://a.b/c/x/z"), ("/../x", "https://a.b/c", "https://a.b/x"),
    ("..", "https://a.b/c/d/e", "https://a.b/c/"), (".", "https://a.b/c/d", "https://a.b/c/"), ("%2E%2e/x", "https://a.b/c/d/", "https://a.b/c/x"),
    ("?q=1", "https://a.b/c/d?z#f", "https://a.b/c/d?q=1"), ("", "https://a.b/c?z#f", "https://a.b/c?z"), ("#t", "https://a.b/c?z#f", "https://a.b/c?z#t"),
    ("//C.d:443/X", "https://a.b/c", "https://c.d/X"), ("HTTP://U:P@Ex.COM:80/A/../B?x=/../y", "https://a.b", "http://U:P@ex.com/B?x=/../y"),
    ("x", "https://a.b", "https://a.b/x"), ("x", "https://a.b?q=/r/s", "https://a.b/x"), ("mailto:A@B", "https://a.b", "mailto:A@B"), (" /p ", "https://a.b:8443/c", "https://a.b:8443/p"),
    ("https://a.b/...", "https://c.d", "https://a.b/..."), ("a/b/../../../../c", "https://a.b/x/", "https://a.b/c"), ("https://x.y", "https://a.b", "https://x.y"),
])
def test_urls_resolve_as_in_browsers(spark, href, base, want):
    assert values(spark, lambda d: urls.resolve_url(F.col("h"), F.col("b")), [(href, base)], "h string, b string") == [want]


def test_a_second_export_appends_nothing(spark):
    cells = sheet_export.CELLS
    export = lambda ids, score: spark.createDataFrame(
        [(i, f"n{i}", "PENDING", score, "1", "2", "3", "u", "c", "d") for i in ids], "company_id long, " + ", ".join(f"{c} string" for c in cells))
    sheet = spark.createDataFrame([(2, 7, "old", "ACCEPTED", *["x"] * 7), (3, 999, "gone", "PENDING", *["y"] * 7)], "row_index long, company_id long, " + ", ".join(f"{c} string" for c in cells))
    first = sheet_export.sync(export(range(1, 261), "9.0"), sheet)
    assert sheet_export.counters(first).first().asDict() == {"companies": 260, "appended": 259, "updated": 1, "untouched": 1, "acted": 260, "skipped": 0, "append_batches": 3, "update_batches": 1}
    rows = {r.company_id: r for r in sheet_export.snapshot(first).collect()}
    assert (rows[7].row_index, rows[7].company_name, rows[7].resolution, rows[7].max_score) == (2, "old", "ACCEPTED", "9.0")
    assert rows[999].max_score == "y" and rows[1].row_index == 4 and rows[260].row_index == 262
    again = sheet_export.sync(export(range(1, 261), "9.5"), sheet_export.snapshot(first))
    assert sheet_export.counters(again).first().asDict() == {"companies": 260, "appended": 0, "updated": 260, "untouched": 1, "acted": 260, "skipped": 0, "append_batches": 0, "update_batches": 6}
