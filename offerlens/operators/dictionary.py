"""Keyword / phrase dictionary: load, validate, compile."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.constants import PHRASE_TIER_WEIGHTS, TIER_WEIGHTS
from offerlens.functions.text import blank_to_null, normalize_tokens
from offerlens.session import local_frame

SHIPPED = Path(__file__).resolve().parent.parent / "data" / "sales_dictionary.json"

DICTIONARY_SCHEMA = """
    version string,
    categories array<struct<id:string,name:string,tier:int>>,
    keywords array<struct<id:string,categoryId:string,canonical:string,aliases:array<string>>>,
    phrases array<struct<id:string,phrase:string,tier:int>>
"""


@dataclass(frozen=True)
class Dictionary:
    """categories(id, name, tier), keywords(ordinal, id, category_id,
    canonical, aliases), phrases(ordinal, id, phrase, tier)."""

    categories: DataFrame
    keywords: DataFrame
    phrases: DataFrame


def read_dictionary(spark: SparkSession, path: str | None = None) -> Dictionary:
    """Read one JSON dictionary file; the file's array order is the ordinal."""
    if path is None:
        text = SHIPPED.read_text(encoding="utf-8")
        source = local_frame(spark, [(text,)], "value string").select(
            F.from_json("value", DICTIONARY_SCHEMA).alias("d")
        ).select("d.*")
    else:
        source = spark.read.schema(DICTIONARY_SCHEMA).json(path, multiLine=True)
    keywords = source.select(F.posexplode("keywords").alias("ordinal", "k")).select(
        "ordinal", "k.id", F.col("k.categoryId").alias("category_id"), "k.canonical", "k.aliases"
    )
    phrases = source.select(F.posexplode("phrases").alias("ordinal", "p")).select("ordinal", "p.*")
    return Dictionary(source.select(F.inline("categories")), keywords, phrases)


def validate_dictionary(d: Dictionary) -> DataFrame:
    """All rule violations as rows (rule, kind, entry_id); empty when valid."""

    def rule(df: DataFrame, kind: str, name: str, bad: Column) -> DataFrame:
        return df.filter(F.coalesce(bad, F.lit(True))).select(
            F.lit(name).alias("rule"), F.lit(kind).alias("kind"), F.col("id").alias("entry_id")
        )

    def blank(name: str) -> Column:
        return blank_to_null(F.col(name)).isNull()

    def repeated(df: DataFrame, kind: str) -> DataFrame:
        return (
            df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select(F.lit("duplicate_id").alias("rule"), F.lit(kind).alias("kind"),
                    F.col("id").alias("entry_id"))
        )

    cat, kw, ph = d.categories, d.keywords, d.phrases
    dangling = kw.join(
        cat.select(F.col("id").alias("category_id")), "category_id", "left_anti"
    ).select(
        F.lit("unknown_category").alias("rule"), F.lit("keyword").alias("kind"),
        F.col("id").alias("entry_id"),
    )
    checks = [
        rule(cat, "category", "blank_id", blank("id")),
        rule(cat, "category", "blank_name", blank("name")),
        rule(cat, "category", "bad_tier", ~F.col("tier").isin(1, 2, 3)),
        rule(kw, "keyword", "blank_id", blank("id")),
        rule(kw, "keyword", "blank_canonical", blank("canonical")),
        rule(kw, "keyword", "empty_aliases", F.size("aliases") < 1),
        rule(kw, "keyword", "blank_alias",
             F.exists("aliases", lambda a: blank_to_null(a).isNull())),
        rule(ph, "phrase", "blank_id", blank("id")),
        rule(ph, "phrase", "blank_phrase", blank("phrase")),
        rule(ph, "phrase", "bad_tier", ~F.col("tier").isin(1, 2, 3)),
        repeated(cat, "category"),
        repeated(kw, "keyword"),
        repeated(ph, "phrase"),
        dangling,
    ]
    for df, name in ((cat, "categories"), (kw, "keywords")):
        checks.append(
            df.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
                F.lit("empty").alias("rule"), F.lit(name).alias("kind"),
                F.lit(None).cast("string").alias("entry_id"))
        )
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out


def _weight(tier: Column, weights: dict[int, float]) -> Column:
    out = F.lit(None).cast("double")
    for value, points in weights.items():
        out = F.when(tier == value, F.lit(points)).otherwise(out)
    return out


def compile_dictionary(d: Dictionary) -> DataFrame:
    """Token patterns, one row per distinct alias or phrase.

    Aliases of a keyword that tokenize alike collapse to their first one.
    Keywords of an unknown category stay as patterns with a null weight: they
    are found and counted, but carry no points.
    """
    alias = d.keywords.select(
        "ordinal", "id", "category_id", F.posexplode("aliases").alias("alias_no", "alias")
    )
    alias = alias.select(
        "ordinal", "alias_no", "id", "category_id", normalize_tokens(F.col("alias")).alias("pattern")
    )
    alias = alias.groupBy("id", "category_id", "pattern").agg(
        F.min(F.struct("ordinal", "alias_no")).alias("o")
    )
    tiers = d.categories.select(
        F.col("id").alias("category_id"), _weight(F.col("tier"), TIER_WEIGHTS).alias("weight")
    )
    keywords = alias.join(tiers, "category_id", "left").select(
        F.lit("keyword").alias("kind"), F.col("id").alias("dict_id"), "category_id", "weight",
        F.col("o").alias("dict_order"), "pattern",
    )
    phrases = d.phrases.select(
        F.lit("phrase").alias("kind"), F.col("id").alias("dict_id"),
        F.lit(None).cast("string").alias("category_id"),
        _weight(F.col("tier"), PHRASE_TIER_WEIGHTS).alias("weight"),
        F.struct("ordinal", F.lit(0).alias("alias_no")).alias("dict_order"),
        normalize_tokens(F.col("phrase")).alias("pattern"),
    )
    return keywords.unionByName(phrases).withColumns({
        "first_token": F.get("pattern", F.lit(0)),
        "n_tokens": F.size("pattern"),
    })


def untokenizable(patterns: DataFrame) -> DataFrame:
    """Aliases and phrases without a token: an error for the caller."""
    return patterns.filter(F.size("pattern") == 0).select("kind", "dict_id")
