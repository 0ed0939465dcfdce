from pyspark.sql import functions as F

from offerlens.constants import SHEET_HEADERS
from offerlens.plans.feedback_apply import apply_sheet


def tables(spark):
    cells = "row_index int, c0 string, c2 string, c10 string, c11 string"
    sheet = spark.createDataFrame([
        (2, "1", "accepted", "ok", "n"), (3, "2", "PENDING", "FP", ""), (4, "1", "rejected", None, None), (5, "9", "ACCEPTED", "ok", ""),
        (6, None, None, None, None), (7, "3", "in_progress", "bad", ""), (8, "x", "accepted", "fn", "y")], cells)
    header = spark.createDataFrame([("s", list(SHEET_HEADERS))], "sheet string, cells array<string>")
    companies = spark.createDataFrame([(1, "PENDING"), (2, "REJECTED"), (3, "IN_PROGRESS")], "id long, resolution string")
    offers = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "offer_id long, company_id long")
    matches = spark.createDataFrame([(10, 1.0), (12, 2.0)], "offer_id long, score double")
    events = spark.createDataFrame([(2, "FP", "")], "company_id long, feedback string, notes string")
    return sheet, header, companies, offers, matches, events


def test_apply(spark):
    got = apply_sheet(*tables(spark), F.lit("2024-01-10 03:30:00").cast("timestamp"))
    assert dict(map(tuple, got.companies.collect())) == {1: "ACCEPTED", 2: "PENDING", 3: "IN_PROGRESS"}
    assert [r.offer_id for r in got.offers.collect()] == [12] and [r.offer_id for r in got.matches.collect()] == [12]
    assert sorted(map(tuple, got.events.collect())) == [(1, "OK", "n"), (2, "FP", ""), (9, "OK", "")]
    c = got.counters.first().asDict()
    assert c == {"total": 7, "valid": 4, "invalid": 1, "duplicate": 1, "changed": 2, "unchanged": 1, "unknown": 1, "destructive": 1, "reversal": 1,
                 "informational": 0, "attempted": 5, "persisted": 3, "failed": 2, "inserted": 2, "offers_deleted": 2}


def test_gates(spark):
    sheet, header, *rest = tables(spark)
    assert apply_sheet(sheet, header, *rest, F.lit("2024-01-10 12:00:00").cast("timestamp")) is None
    wrong = header.withColumn("cells", F.expr("array_append(slice(cells, 2, 100), 'x')"))
    assert apply_sheet(sheet, wrong, *rest, F.lit("2024-01-10 03:30:00").cast("timestamp")) is None
