"""Keyed merges as joins: fold the updates per key, then full outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_values(updates: DataFrame, key: list[str], seq: str, columns: list[str]) -> DataFrame:
    """Per key and column the latest non-null value (map-side combinable)."""
    return updates.groupBy(*key).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns])


def last_rows(updates: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The last whole row per key."""
    rest = [c for c in updates.columns if c not in key]
    return updates.groupBy(*key).agg(F.max_by(F.struct(*rest), seq).alias("r")).select(*key, "r.*")


def merge_coalesce(
    existing: DataFrame, updates: DataFrame, key: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """New non-null values win, nulls keep the old; ``keep`` never changes once set."""
    columns = [c for c in existing.columns if c not in key]
    e = existing.select(*key, F.struct(*columns).alias("old"))
    u = updates.select(*key, F.struct(*columns).alias("new"))
    return e.join(u, key, "full_outer").select(*key, *[
        (F.coalesce(f"old.{c}", f"new.{c}") if c in keep else F.coalesce(f"new.{c}", f"old.{c}"))
        .alias(c) for c in columns])


def merge_overwrite(
    existing: DataFrame, updates: DataFrame, key: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """An updated key takes the new row as it is, nulls included, except ``keep``."""
    columns = [c for c in existing.columns if c not in key]
    e = existing.select(*key, F.struct(*columns).alias("old"))
    u = updates.select(*key, F.struct(*[c for c in columns if c not in keep]).alias("new"))
    return e.join(u, key, "full_outer").select(*key, *[
        (F.col(f"old.{c}") if c in keep
         else F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))).alias(c)
        for c in columns])


def update_resolution(companies: DataFrame, changes: DataFrame) -> DataFrame:
    """Set differing resolutions; ``changed`` marks the touched rows."""
    new = changes.select("id", F.col("resolution").alias("new"))
    return companies.join(new, "id", "left").select(
        "id", F.coalesce("new", "resolution").alias("resolution"),
        (F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("resolution"))).alias("changed"))


def delete_offers(offers: DataFrame, companies: DataFrame) -> DataFrame:
    return offers.join(companies.select("company_id").distinct(), "company_id", "left_anti")


def cascade(matches: DataFrame, offers: DataFrame) -> DataFrame:
    """Match rows whose offer still exists."""
    return matches.join(offers.select("offer_id"), "offer_id", "left_semi")


def insert_ignore(existing: DataFrame, events: DataFrame, key: list[str]) -> DataFrame:
    """New events only, one whole row per key (null keys count as equal to blank).

    Of several new rows with one key the smallest by its other columns stays.
    """
    marks = [f"__key{k}" for k in range(len(key))]
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(m) for c, m in zip(key, marks)]
    one = events.groupBy(*blank).agg(F.min(F.struct(*events.columns)).alias("row"))
    return one.join(existing.select(*blank).distinct(), marks, "left_anti").select("row.*")


def companies_by_name(rows: DataFrame) -> DataFrame:
    """One global company per normalized name."""
    return rows.filter("normalized_name IS NOT NULL").groupBy("normalized_name").agg(
        F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"),
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("members"))


def partial_update(existing: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Change only supplied fields: for each column c, ``set_c`` says whether
    the update supplies it (a supplied null clears the field)."""
    columns = [c for c in existing.columns if c != key]
    u = updates.select(key, F.struct(*columns, *[f"set_{c}" for c in columns]).alias("u"))
    return existing.join(u, key, "left").select(key, *[
        F.when(F.col(f"u.set_{c}"), F.col(f"u.{c}")).otherwise(F.col(c)).alias(c) for c in columns])
