"""Reports over run tables, scores of described offers only, external links by one scan."""

from datetime import datetime

from pyspark.sql import functions as F

from offerlens.operators import extraction, runs, scoring


def test_lock_report_at_and_around_the_expiry(spark):
    at = datetime(2024, 5, 1, 11)
    rows = [("held", "a", at, datetime(2024, 5, 1, 12, 0, 30)), ("due", "b", at, datetime(2024, 5, 1, 12)),
            ("old", "c", at, datetime(2024, 5, 1, 11, 59)), ("open", None, at, None)]
    locks = spark.createDataFrame(rows, "lock_name string, owner_id string, acquired_at timestamp, expires_at timestamp")
    got = {r.lock_name: (r.lock_status, r.seconds_until_expiry) for r in runs.lock_report(locks, F.lit("2024-05-01 12:00:00").cast("timestamp")).collect()}
    assert got == {"held": ("ACTIVE", 30), "due": ("EXPIRED", 0), "old": ("EXPIRED", -60), "open": ("EXPIRED", None)}


def test_table_counts_with_an_empty_table(spark):
    got = runs.table_counts({"b": spark.range(3), "a": spark.range(0)}).collect()
    assert sorted(map(tuple, got)) == [("a", 0), ("b", 3)]


def test_recent_runs_newest_first_with_ties(spark):
    ledger = spark.createDataFrame([("r1", "2024-01-01"), ("r3", "2024-01-02"), ("r2", "2024-01-02"), ("r0", None)], "run_id string, started_at string")
    assert [r.run_id for r in runs.recent_runs(ledger, 3).collect()] == ["r2", "r3", "r1"]


def test_external_links_by_one_scan(spark):
    rows = [(1, "https://a.test/x", '<a href="https://b.test/">B</a>'), (2, "https://a.test/x", '<a href="/in">in</a><a href="https://www.a.test">own</a>'),
            (3, "https://a.test/x", '<a href="https://c.test"> <b> </b></a>'), (4, "https://a.test/x", None), (5, None, '<a href="https://b.test">B</a>'),
            (6, "https://a.test", '<a href="/in">in</a> <a class="k" href="https://d.test/f.pdf">f</a><a href="https://d.test/f">f</a>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = extraction.has_external_candidates(pages, "page_id")
    by_links = {r.page_id for r in extraction.external_links(pages, "page_id").collect()}
    assert {r.page_id: r.has_external for r in found.collect()} == {r[0]: r[0] in by_links for r in rows}
    assert {1, 6} <= by_links and not {2, 3, 4} & by_links
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_offers_without_description_stay_unscored(spark):
    offers = spark.createDataFrame([(1, "t", "text"), (2, "t", None), (3, "t", " ")], "offer_id long, title string, description string")
    assert sorted(r.offer_id for r in scoring.with_description(offers).collect()) == [1, 3]
