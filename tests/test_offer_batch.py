import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from offerlens.operators.ledger import LEDGER, run_ledger
from offerlens.plans import offer_batch as ob
from offerlens.session import checkpoint_folder, materialized, materialized_result
from offerlens.sinks.snapshots import Snapshots
from tests.test_rules import small_dictionary

FIELDS = [part.split()[0] for part in ob.ARRIVING.replace("\n", " ").split(",")]


def offers(spark, rows):
    full = []
    for seq, row in enumerate(rows):
        row = {"seq": seq, "provider": "infojobs", "provider_url": "https://x.test/1", "company_name": "Acme S.L.", "title": None,
               "description": None, "updated_at": f"2024-01-0{seq % 9 + 1}", **row}
        full.append(tuple(row.get(k) for k in FIELDS))
    return spark.createDataFrame(full, ob.ARRIVING)


def text(word, n=30):
    return " ".join(f"{word}{k}" for k in range(n))


class Runs:
    """A state folder, and batches run against it."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        self.snapshots = Snapshots(spark, f"{path}/state", ob.SCHEMAS)
        self.patterns = small_dictionary(spark, [("cat_fx_a", 0)], ("dollar",))
        self.clock = itertools.count(1)

    def run(self, rows, batch):
        return ob.run_offer_batch(self.snapshots, f"{self.path}/ledger", "infojobs", offers(self.spark, rows), self.patterns,
                                  lambda: f"2024-02-01T00:00:{next(self.clock):02d}", batch)

    def rows(self, name, key):
        return {r[key]: r for r in self.snapshots.read(name).collect()}

    def ledger(self):
        return run_ledger(self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger")).orderBy("started_at").collect()


@pytest.fixture
def runs(spark, tmp_path):
    return Runs(spark, tmp_path)


FIRST = [
    {"provider_offer_id": "a", "title": "Dollar desk", "description": text("a")},
    {"provider_offer_id": "b", "title": "Other", "description": text("a", 29) + " z"},          # similar: a repost of a
    {"provider_offer_id": "c", "title": "dollar, DESK", "description": "short"},                  # equal title
    {"provider_offer_id": "d", "provider_url": " ", "title": "No link"},
    {"provider_offer_id": "e", "provider": "lever", "description": " ", "title": "No text"},
    {"provider_offer_id": "f", "company_name": None, "title": "Nobody"},
    {"provider_offer_id": "g", "company_name": "Beta", "website_url": "https://www.Beta.com/x", "title": "Sales", "description": text("g")},
    {"provider_offer_id": "g", "company_name": "Beta", "website_url": "https://beta.com", "title": "Sales 2"},   # an update in the batch, without a text
    {"provider_offer_id": "h", "company_name": "beta", "title": "By name"},                       # same company by name
]


def test_outcomes_tables_and_counters(runs):
    got = runs.run(FIRST, "one")
    assert [r.outcome for r in sorted(runs.snapshots.read("outcomes").collect(), key=lambda r: r.seq)] == [
        "inserted", "repost_duplicate", "repost_duplicate", "missing_provider_url", "missing_description", "company_unidentifiable", "inserted", "updated", "inserted"]
    assert got == {"offers_fetched": 9, "offers_upserted": 4, "offers_duplicates": 2, "offers_skipped": 3, "offers_failed": 0,
                   "offers_skipped_missing_description": 1, "offers_skipped_repost_duplicate": 2, "affected_companies": 2, "companies_failed": 0, "companies_aggregated": 2}
    companies = runs.rows("companies", "id")
    assert [(c.normalized_name, c.website_domain, c.resolution) for _, c in sorted(companies.items())] == [("acme", None, "PENDING"), ("beta", "beta.com", "PENDING")]
    acme, beta = companies[1], companies[2]
    assert (acme.max_score, acme.offer_count, acme.unique_offer_count, acme.top_offer_id) == (6.0, 3, 1, 1) and acme.category_max_scores == '{"cat_fx_a":6.0}'
    assert (beta.max_score, beta.offer_count) == (0.0, 2)
    stored = runs.rows("offers", "provider_offer_id")
    assert {k: (r.offer_id, r.repost_count, r.last_seen_at) for k, r in stored.items()} == {
        "a": (1, 2, "2024-01-03"), "g": (2, 0, "2024-01-08"), "h": (3, 0, "2024-01-09")}
    assert stored["g"].title == "Sales 2" and stored["g"].description is None and stored["g"].content_fingerprint is not None
    assert set(runs.rows("matches", "offer_id")) == {1, 2}  # g was scored when it came with a text
    assert runs.snapshots.read("company_sources").count() == 6


def test_a_rerun_changes_only_when_it_was_seen(runs):
    plain = [FIRST[0], FIRST[6], FIRST[8]]
    runs.run(plain, "one")
    before = {n: runs.snapshots.read(n) for n in ("companies", "offers", "matches")}
    assert runs.run(plain, "one") is None and runs.snapshots.latest()["version"] == 1
    again = [{**r, "updated_at": f"2025-0{k + 1}-01"} for k, r in enumerate(plain)]
    assert runs.run(again, "two")["offers_upserted"] == 3
    changing = {"offers": ["last_seen_at", "last_updated_at", "updated_at"], "matches": ["computed_at"], "companies": ["last_strong_at"]}
    for name, old in before.items():
        new = runs.snapshots.read(name)
        assert sorted(old.drop(*changing[name]).collect(), key=str) == sorted(new.drop(*changing[name]).collect(), key=str)
    assert [r.last_seen_at for _, r in sorted(runs.rows("offers", "offer_id").items())] == ["2025-01-01", "2025-02-01", "2025-03-01"]


def test_stored_offers_updates_and_resolved_companies(runs):
    runs.run(FIRST, "one")
    state = runs.snapshots.tables()
    rejected = state["companies"].withColumn("resolution", F.expr("CASE WHEN id = 2 THEN 'REJECTED' ELSE resolution END"))
    runs.snapshots.commit("feedback", {"companies": rejected})
    got = runs.run([
        {"provider_offer_id": "k", "title": "New", "description": text("a")},                     # equal text to the stored offer a
        {"provider_offer_id": "a", "title": "Dollar desk", "description": text("n")},             # a gets a new text ...
        {"provider_offer_id": "l", "title": "Newer", "description": text("a", 29) + " y"},        # ... so its old text is free again
        {"provider_offer_id": "m", "title": "Newest", "description": text("n", 29) + " x"},       # and the new one is taken
        {"provider_offer_id": "a", "title": "Dollar desk", "description": text("n")},             # seen once more, unchanged
        {"provider_offer_id": "q", "title": "Late", "description": text("n", 29) + " w"},
        {"provider_offer_id": "n", "company_name": "Beta", "title": "Resolved"},
        {"provider_offer_id": "o", "company_name": "acme", "website_url": "https://beta.com", "title": "Clash"},
        {"provider_offer_id": "p", "known_company_id": 1, "company_name": None, "title": "From a tenant"},
    ], "two")
    found = {r.provider_offer_id: r for r in runs.snapshots.read("outcomes").collect()}
    assert {k: (r.outcome, r.offer_id, r.canonical_id) for k, r in found.items()} == {
        "q": ("repost_duplicate", None, 1), "k": ("repost_duplicate", None, 1), "a": ("updated", 1, None), "l": ("inserted", 4, None), "m": ("repost_duplicate", None, 1),
        "n": ("company_resolved", None, None), "o": ("failed", None, None), "p": ("inserted", 5, None)}
    assert (got["offers_failed"], got["offers_skipped"], got["affected_companies"]) == (1, 1, 2)
    acme = runs.rows("companies", "id")[1]
    assert (acme.offer_count, acme.unique_offer_count) == (1 + 5 + 2, 3)
    assert runs.rows("companies", "id")[2].resolution == "REJECTED"


def test_ledger_has_a_row_for_success_and_failure(runs):
    counts = runs.run(FIRST, "one")
    broken = offers(runs.spark, FIRST[:2]).withColumn("title", F.raise_error(F.lit("broken feed")).cast("string"))
    with pytest.raises(Exception, match="broken feed"):
        ob.run_offer_batch(runs.snapshots, f"{runs.path}/ledger", "lever", broken, runs.patterns, lambda: "2024-05-01", "bad", "lever:x")
    assert runs.snapshots.latest()["version"] == 1 and not runs.snapshots.has("bad")
    ok, bad = runs.ledger()
    assert ok.status == "success" and {k: ok[k] for k in counts} == counts and ok.finished_at > ok.started_at
    assert (bad.status, bad.provider, bad.query_key, bad.offers_fetched) == ("failure", "lever", "lever:x", None) and "broken feed" in bad.error
    assert run_ledger(runs.spark.createDataFrame([("r", "p", None, "t", "running", None) + (None,) * 10], LEDGER)).first().status == "running"


def test_an_empty_batch(runs):
    assert runs.run([], "none")["offers_fetched"] == 0 and runs.snapshots.read("offers").count() == 0


def test_tables_between_the_steps_go_with_the_batch(spark, runs):
    folder = Path(checkpoint_folder(spark).removeprefix("file:"))
    before = set(folder.glob("table-*"))
    runs.run(FIRST, "1")
    assert set(folder.glob("table-*")) <= before
    made = materialized_result(spark, lambda: materialized(spark.range(3)).join(materialized(spark.range(2)), "id"))
    assert len(set(folder.glob("table-*")) - before) == 1 and made.count() == 2
