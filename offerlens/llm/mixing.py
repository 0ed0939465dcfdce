"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output over its share of the input. Each
document draws its number of copies by inverting the Poisson distribution at a uniform number that is
hashed from the seed, its id and its text, so a rerun on any number of tasks gives the same copies. A rate
above ``MAX_RATE`` is drawn as a sum of independent draws of equal, smaller rates, which has the same
distribution. Copies are dealt out by a hash of (seed, document, copy): a global shuffle.

Weights are per source and need not sum to 1; sources that are not named share the weight
``other`` each. A null source is the source named by the empty string. Null ids and texts hash as empty;
equal rows draw alike; an empty table gives an empty result. Columns of the input are kept; new ones are
``copy`` and ``shuffle_key``, which replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c

MAX_RATE = 8.0
#: Beyond so many copies the chance of a draw at MAX_RATE is below 2**-52.
MOST = 48
SALTS = 64
SEED = "mix-1"


def uniform(*parts):
    """A number in (0, 1) from the first 52 bits of an MD5 hash."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, other: float = 1.0) -> DataFrame:
    """source, rate: the mean number of copies so that the output is as large as the input."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("__source")).agg(F.count("*").alias("__docs"))
    weight = F.lit(float(other))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("__source") == name, float(value)).otherwise(weight)
    counts = counts.withColumn("__weight", weight)
    total = counts.agg(F.sum("__docs").alias("__all"), F.sum("__weight").alias("__weights"))
    share = F.col("__weight") / F.col("__weights")
    # written, so that the optimizer knows its size: it is broadcast only below the session's threshold
    return c.written(counts.join(F.broadcast(total)).select("__source", (share * F.col("__all") / F.col("__docs")).alias("__rate")))


def poisson_copies(rate, at):
    """The smallest k whose cumulative probability exceeds ``at``."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST)),
        F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.lit(0).alias("k")),
        lambda s, i: F.struct(
            (s["p"] * rate / i).alias("p"), (s["sum"] + s["p"] * rate / i).alias("sum"),
            (s["k"] + F.when(s["sum"] <= at, 1).otherwise(0)).alias("k")))
    return step["k"]


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, other: float = 1.0, seed: str = SEED) -> DataFrame:
    """Every document as often as its draw says, with ``copy`` (from 1) and ``shuffle_key``, shuffled."""
    docs = docs.drop("copy", "shuffle_key")
    ident = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))
    rate = rates(docs, weights, other)
    # with more sources than can be broadcast the join is a shuffle: a hot source is spread over its salts
    salted = rate.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = docs.withColumn("__source", F.coalesce("source", F.lit(""))).withColumn("__ident", ident).withColumn(
        "__salt", F.pmod(F.xxhash64("__ident"), F.lit(SALTS)).cast("int")).join(salted, ["__source", "__salt"])
    parts = F.greatest(F.lit(1), F.ceil(F.col("__rate") / MAX_RATE).cast("int"))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("__parts")), F.lit(0),
        lambda n, i: n + poisson_copies(F.col("__rate") / F.col("__parts"), uniform(F.lit(seed), F.col("__ident"), i.cast("string"))))
    drawn = joined.withColumn("__parts", parts).withColumn("__copies", drawn).filter("__copies > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).withColumn(
        "shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), F.col("__ident"), F.col("copy").cast("string"))))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key").select(*docs.columns, "copy", "shuffle_key")


def mix_sql(source: str, seed: str = SEED) -> str:
    """The same rows in DuckDB's SQL, all sources with equal weight; needs WITH RECURSIVE before it."""
    number = "(('0x' || substr(md5('{seed}' || '|' || ident || '|' || part), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0".replace("{seed}", seed)
    return f"""
mix_docs AS (SELECT *, md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS ident, coalesce(source, '') AS src FROM {source}),
mix_rates AS (SELECT src, (1.0::DOUBLE / count(*) OVER ()) * sum(n) OVER ()::DOUBLE / n AS rate FROM (SELECT src, count(*) AS n FROM mix_docs GROUP BY 1)),
mix_parts AS (SELECT src, rate, greatest(1, ceil(rate / {MAX_RATE})::INT) AS parts FROM mix_rates),
mix_cdf AS (
  SELECT src, parts, rate / parts AS r, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS s, 0 AS k FROM mix_parts
  UNION ALL SELECT src, parts, r, p * r / (k + 1), s + p * r / (k + 1), k + 1 FROM mix_cdf WHERE k < {MOST}),
mix_draws AS (SELECT DISTINCT ident, src, part, {number} AS u
  FROM mix_docs JOIN mix_parts USING (src), unnest(range(1, parts + 1)) AS t(part)),
mix_copies AS (SELECT ident, src, count(*) AS copies FROM mix_draws d JOIN mix_cdf f USING (src)
  WHERE f.s <= d.u AND f.k < {MOST} GROUP BY 1, 2),
mixed AS (SELECT d.*, copy, md5('{seed}' || '|' || d.ident || '|' || copy) AS shuffle_key
  FROM mix_docs d JOIN mix_copies c USING (ident, src), unnest(range(1, c.copies + 1)) AS t(copy))"""
