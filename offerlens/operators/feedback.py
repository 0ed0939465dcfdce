"""Sheet feedback: cell parsers, reads, comparison, change classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.constants import (
    FEEDBACK_HOURS,
    FEEDBACK_ZONE,
    MODEL_FEEDBACK,
    RESOLUTIONS,
    RESOLVED,
)
from offerlens.functions.text import trim_space


def parse_company_id(cell: Column) -> Column:
    text = trim_space(cell)
    number = F.when(text.rlike(r"^[0-9]+$"), text.try_cast("bigint"))
    return F.when(number > 0, number)


def parse_enum(cell: Column, values: tuple[str, ...]) -> Column:
    text = F.upper(trim_space(cell))
    return F.when(text.isin(*values), text)


def parse_resolution(cell: Column) -> Column:
    return parse_enum(cell, RESOLUTIONS)


def parse_model_feedback(cell: Column) -> Column:
    return parse_enum(cell, MODEL_FEEDBACK)


def first_rows(rows: DataFrame) -> DataFrame:
    """The first sheet row of each company id."""
    rest = [c for c in rows.columns if c != "company_id"]
    return rows.groupBy("company_id").agg(F.min_by(F.struct(*rest), "row_index").alias("r")).select(
        "company_id", "r.*")


def read_resolutions(sheet: DataFrame) -> DataFrame:
    """(company_id, resolution): invalid cells go before the duplicate check."""
    parsed = sheet.select(
        "row_index", parse_company_id(F.col("c0")).alias("company_id"),
        parse_resolution(F.col("c2")).alias("resolution"))
    return first_rows(parsed.filter("company_id IS NOT NULL AND resolution IS NOT NULL"))


def read_index(sheet: DataFrame) -> DataFrame:
    """(company_id, row_index, resolution) of the first row per id; a null resolution is allowed."""
    parsed = sheet.select(
        "row_index", parse_company_id(F.col("c0")).alias("company_id"),
        parse_resolution(F.col("c2")).alias("resolution"))
    return first_rows(parsed.filter("company_id IS NOT NULL"))


def read_counters(sheet: DataFrame) -> DataFrame:
    """Rows in all; valid, invalid and repeated ones. A blank row only counts in all."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sheet.columns if c != "row_index"]
    parsed = sheet.select(
        parse_company_id(F.col("c0")).alias("company_id"), parse_resolution(F.col("c2")).alias("r"),
        (F.concat(*cells) == "").alias("blank"))
    ok = F.col("company_id").isNotNull() & F.col("r").isNotNull()
    per_id = parsed.groupBy("company_id", "blank", ok.alias("ok")).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return per_id.agg(
        F.coalesce(F.sum("n"), zero).alias("total"), F.count_if("ok").alias("valid"),
        F.coalesce(F.sum(F.when(~F.col("ok") & ~F.col("blank"), F.col("n"))), zero).alias("invalid"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n") - 1)), zero).alias("duplicate"))


def read_model_feedback(sheet: DataFrame) -> DataFrame:
    """Rows with non-blank feedback; bad ids or values are marked invalid."""
    rows = sheet.filter(F.coalesce(trim_space(F.col("c10")) != "", F.lit(False)))
    parsed = rows.select(
        "row_index", parse_company_id(F.col("c0")).alias("company_id"),
        parse_model_feedback(F.col("c10")).alias("feedback"),
        F.coalesce(trim_space(F.col("c11")), F.lit("")).alias("notes"))
    return parsed.withColumn(
        "is_valid", F.col("company_id").isNotNull() & F.col("feedback").isNotNull())


def in_feedback_window(ts: Column) -> Column:
    hour = F.hour(F.from_utc_timestamp(ts, FEEDBACK_ZONE))
    return (hour >= FEEDBACK_HOURS[0]) & (hour < FEEDBACK_HOURS[1])


def ordered_plan(plan: DataFrame) -> DataFrame:
    """Changes of all classes in one table, by class and company id."""
    return plan.filter("state = 'changed'").orderBy("classification", "company_id")


def change_plan(feedback: DataFrame, companies: DataFrame) -> DataFrame:
    """Feedback against stored resolutions with state and change class."""
    stored = companies.select(
        F.col("id").alias("company_id"), F.col("resolution").alias("from_resolution"),
        F.lit(True).alias("known"))
    joined = feedback.select("company_id", F.col("resolution").alias("to_resolution")).join(
        stored, "company_id", "left")
    same = F.col("from_resolution").eqNullSafe(F.col("to_resolution"))
    was = F.coalesce(F.col("from_resolution").isin(*RESOLVED), F.lit(False))
    now = F.col("to_resolution").isin(*RESOLVED)
    return joined.select(
        "company_id", "from_resolution", "to_resolution",
        F.when(F.col("known").isNull(), "unknown").when(same, "unchanged").otherwise("changed")
        .alias("state"),
        F.when(~was & now, "destructive").when(was & ~now, "reversal").otherwise("informational")
        .alias("classification"))
