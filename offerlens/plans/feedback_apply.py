"""Sheet feedback applied in one plan: gates, reads, changes, cascade, stored feedback, counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.operators.company_sources import apply_feedback, header_mismatches
from offerlens.operators.feedback import change_plan, in_feedback_window, read_counters, read_model_feedback, read_resolutions
from offerlens.operators.merges import cascade, insert_ignore

EVENT_KEY = ["company_id", "feedback", "notes"]


@dataclass(frozen=True)
class Applied:
    """Tables after the feedback, the change plan, and one row of counters."""

    companies: DataFrame
    offers: DataFrame
    matches: DataFrame
    events: DataFrame
    plan: DataFrame
    counters: DataFrame


def may_apply(header: DataFrame, now: Column) -> bool:
    """Inside the feedback window, and the sheet's header is the expected one."""
    gate = header.sparkSession.range(1).select(in_feedback_window(now).alias("ok"))
    return bool(gate.first()["ok"]) and header_mismatches(header).isEmpty()


def apply_sheet(
    sheet: DataFrame, header: DataFrame, companies: DataFrame, offers: DataFrame, matches: DataFrame,
    events: DataFrame, now: Column,
) -> Applied | None:
    """Apply resolutions and store model feedback; None when a gate is closed.

    ``companies``: id, resolution, ...; ``offers``: offer_id, company_id, ...;
    ``matches``: offer_id, ...; ``events``: company_id, feedback, notes. A
    stored event that comes again counts as persisted, though it is not
    inserted again.
    """
    if not may_apply(header, now):
        return None
    plan = change_plan(read_resolutions(sheet), companies)
    updated, left = apply_feedback(plan, companies, offers)
    read = read_model_feedback(sheet)
    fresh = insert_ignore(events, read.filter("is_valid").select(*EVENT_KEY), EVENT_KEY)
    changed = F.col("state") == "changed"
    changes = plan.agg(
        F.count_if(changed).alias("changed"), F.count_if(F.col("state") == "unchanged").alias("unchanged"),
        F.count_if(F.col("state") == "unknown").alias("unknown"),
        *[F.count_if(changed & (F.col("classification") == c)).alias(c) for c in ("destructive", "reversal", "informational")])
    stored = read.agg(F.count(F.lit(1)).alias("attempted"), F.count_if("is_valid").alias("persisted"), F.count_if(~F.col("is_valid")).alias("failed"))
    inserted = fresh.agg(F.count(F.lit(1)).alias("inserted"))
    gone = offers.join(left.select("offer_id"), "offer_id", "left_anti").agg(F.count(F.lit(1)).alias("offers_deleted"))
    counters = read_counters(sheet)  # every part is one row
    for part in (changes, stored, inserted, gone):
        counters = counters.join(F.broadcast(part))
    return Applied(updated, left, cascade(matches, left), events.select(*EVENT_KEY).unionByName(fresh), plan, counters)
