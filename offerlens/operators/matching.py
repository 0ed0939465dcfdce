"""Dictionary hits in offer texts, with negation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.constants import FIELD_WEIGHTS, NEGATION_AFTER, NEGATION_BEFORE, NEGATION_CUES
from offerlens.functions.text import tokens_or_empty
from offerlens.session import materialized


def is_negated(tokens: Column, start: Column, length: Column) -> Column:
    """A cue stands among the tokens just before or just after the span."""
    cues = F.array(*[F.lit(c) for c in NEGATION_CUES])
    first = F.greatest(start - NEGATION_BEFORE, F.lit(0))
    before = F.slice(tokens, first + 1, start - first)
    after = F.slice(tokens, start + length + 1, F.lit(NEGATION_AFTER))
    return F.arrays_overlap(before, cues) | F.arrays_overlap(after, cues)


def field_tokens(offers: DataFrame, *keys: str) -> DataFrame:
    """(keys, field, field_no, tokens): title and description as rows."""
    fields = F.array(*[
        F.struct(
            F.lit(name).alias("field"),
            F.lit(no).alias("field_no"),
            tokens_or_empty(F.col(name)).alias("tokens"),
        )
        for no, name in enumerate(FIELD_WEIGHTS)
    ])
    return offers.select(*keys, F.inline(fields))


def find_hits(tokens: DataFrame, patterns: DataFrame, *keys: str) -> DataFrame:
    """Every occurrence of every pattern, overlaps and repeats included.

    Each token position meets only the patterns that begin with its token, and
    the rest of the pattern is compared on the few rows that survive. The
    patterns are computed once; the optimizer broadcasts them if they are small.
    """
    positions = tokens.select(
        *keys, "field", "field_no", "tokens", F.posexplode("tokens").alias("token_index", "token")
    )
    found = positions.join(materialized(patterns), F.col("token") == F.col("first_token")).filter(F.slice("tokens", F.col("token_index") + 1, F.col("n_tokens")) == F.col("pattern"))
    field_weight = F.lit(1.0)
    for name, weight in FIELD_WEIGHTS.items():
        field_weight = F.when(F.col("field") == name, F.lit(weight)).otherwise(field_weight)
    # title before description, then position, then dictionary order
    ordinal = F.struct("field_no", "token_index", "dict_order.ordinal", "dict_order.alias_no")
    return found.select(
        *keys, "kind", "dict_id", "category_id", "field", "token_index",
        F.col("pattern").alias("matched_tokens"),
        is_negated(F.col("tokens"), F.col("token_index"), F.col("n_tokens")).alias("is_negated"),
        (F.col("weight") * field_weight).alias("points"),
        ordinal.alias("ordinal"),
    )


def match_offers(offers: DataFrame, patterns: DataFrame, *keys: str) -> DataFrame:
    return find_hits(field_tokens(offers, *keys), patterns, *keys)


def match_summary(hits: DataFrame, *keys: str) -> DataFrame:
    """Counts per offer; negated hits count here as well."""
    keyword = F.col("kind") == "keyword"
    # two levels keep the distinct counts free of row expansion
    per_entry = hits.groupBy(*keys, "kind", "category_id", "dict_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    per_category = per_entry.groupBy(*keys, "kind", "category_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("entries")
    )
    zero = F.lit(0).cast("long")
    return per_category.groupBy(*keys).agg(
        F.sum(F.when(keyword, F.col("n")).otherwise(zero)).alias("keyword_hits"),
        F.sum(F.when(~keyword, F.col("n")).otherwise(zero)).alias("phrase_hits"),
        F.count_if(keyword).alias("unique_categories"),
        F.sum(F.when(keyword, F.col("entries")).otherwise(zero)).alias("unique_keywords"),
    )
