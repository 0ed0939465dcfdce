"""Companies by two keys: website domain first, normalized name otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.operators.merges import latest_values

ATTRIBUTES = ("name_raw", "name_display", "normalized_name", "website_url")


def _key(domain: Column, name: Column) -> Column:
    return F.coalesce(F.concat(F.lit("d:"), domain), F.concat(F.lit("n:"), name))


def resolve_companies(existing: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Arrivals with ``company_key`` and ``problem`` (null, unidentifiable or conflict).

    ``existing``: id, website_domain, normalized_name; ``arrivals``: seq,
    website_domain, normalized_name and more. A domain decides alone. A name
    belongs to the stored company that bears it, else to the first arrival
    that does; an arrival whose domain and name belong to different companies
    is a conflict. A company keeps the names it had, also after a new one.
    """
    stored = existing.filter("normalized_name IS NOT NULL").groupBy("normalized_name").agg(
        F.min_by(_key(F.col("website_domain"), F.col("normalized_name")), "id").alias("stored_owner"))
    first = arrivals.filter("normalized_name IS NOT NULL").groupBy("normalized_name").agg(
        F.min_by(_key(F.col("website_domain"), F.col("normalized_name")), "seq").alias("first_owner"))
    owners = first.join(stored, "normalized_name", "left").select(
        "normalized_name", F.coalesce("stored_owner", "first_owner").alias("owner"))
    by_domain = F.concat(F.lit("d:"), F.col("website_domain"))
    return arrivals.join(owners, "normalized_name", "left").select(
        *arrivals.columns, F.coalesce(by_domain, F.col("owner")).alias("company_key"),
        F.when(F.coalesce("website_domain", "normalized_name").isNull(), "unidentifiable")
        .when(by_domain != F.col("owner"), "conflict").alias("problem"))


def merge_companies(existing: DataFrame, resolved: DataFrame) -> DataFrame:
    """The company table after the accepted arrivals: id (null for a new one), company_key, domain and attributes.

    A non-null value of the latest arrival wins, nulls keep what was there.
    """
    fresh = latest_values(resolved.filter("problem IS NULL"), ["company_key"], "seq", ["website_domain", *ATTRIBUTES])
    old = existing.withColumn("company_key", _key(F.col("website_domain"), F.col("normalized_name")))
    columns = ["website_domain", *ATTRIBUTES]
    return old.select("company_key", "id", F.struct(*columns).alias("old")).join(
        fresh.select("company_key", F.struct(*columns).alias("new")), "company_key", "full_outer").select(
        "id", "company_key", *[F.coalesce(f"new.{c}", f"old.{c}").alias(c) for c in columns])


def rekey(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Move rows from per-provider companies to the global company of the same name.

    ``members``: id, normalized_name, created_at. Rows of companies without a
    name have no global company and go.
    """
    named = members.filter("normalized_name IS NOT NULL")
    first = named.groupBy("normalized_name").agg(F.min("id").alias("global_id"))
    return rows.join(named.join(first, "normalized_name").select(F.col("id").alias("company_id"), "global_id"), "company_id").select(
        F.col("global_id").alias("company_id"), *[c for c in rows.columns if c != "company_id"])
