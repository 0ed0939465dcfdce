"""How the given tables stand in for offers, companies and dictionaries.

Every helper has two faces: a DataFrame for the Spark side and a list of SQL
common table expressions for the counterpart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.operators.dictionary import Dictionary, compile_dictionary
from offerlens.session import local_frame, spread

SEP = (
    r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
    r"/\\|()\[\]{},;:.!?\"''\-_\x{201c}\x{201d}\x{2018}\x{2019}\x0b]+"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- offers out of documents ------------------------------------------------


def document_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as offers: the company is the source, the title the first line."""
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").alias("offer_id"),
        F.col("source").alias("company_id"),
        F.get(F.split("text", "\n"), F.lit(0)).alias("title"),
        F.col("text").alias("description"),
        F.expr(
            "date_format(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id),"
            " \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        ).alias("published_at"),
    )


OFFERS_SQL = """offers AS (
  SELECT doc_id AS offer_id, source AS company_id, split_part(text, chr(10), 1) AS title,
         text AS description,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id), '%Y-%m-%dT%H:%M:%SZ')
           AS published_at
  FROM documents)"""


def tokens_sql(name: str, source: str, keys: str, text: str) -> str:
    """CTEs that tokenize ``text`` of ``source`` into ``name(keys, tokens)``."""
    return f"""{name}_w AS (
  SELECT {keys}, list_filter(regexp_split_to_array(strip_accents(lower(coalesce({text}, ''))),
           '{SEP}'), lambda t: t <> '') AS w FROM {source}),
{name}_c AS (
  SELECT {keys}, flatten(list_transform(w, lambda t: list_filter([t,
           CASE WHEN contains(t, '$') THEN 'usd' END, CASE WHEN contains(t, '£') THEN 'gbp' END,
           CASE WHEN contains(t, '€') THEN 'eur' END], lambda z: z IS NOT NULL))) AS w
  FROM {name}_w),
{name} AS (
  SELECT {keys}, flatten(list_transform(w, lambda t, i:
           CASE WHEN t = 'u' AND w[i + 1] = 's' THEN ['u', 'us', 'usa']
                WHEN t = 'u' AND w[i + 1] = 'k' THEN ['u', 'uk']
                WHEN t = 'eeuu' THEN ['eeuu', 'us', 'usa']
                WHEN t = 'latinoamerica' THEN ['latinoamerica', 'latam'] ELSE [t] END)) AS tokens
  FROM {name}_c)"""


# --- a dictionary that hits the invented words of documents -------------------

CATEGORIES = [
    ("cat_fx_core", "Currency", 3),
    ("cat_fx_trade", "Trade", 2),
    ("cat_intl_reach", "Reach", 2),
    ("cat_biz_ops", "Operations", 2),
    ("cat_proxy_stack", "Stack", 1),
    ("misc_other", "Other", 1),
]
KEYWORDS = [
    ("kw_usd", "cat_fx_core", ["usd"]),
    ("kw_erin", "cat_fx_core", ["erin", "erin the"]),
    ("kw_anea", "cat_fx_trade", ["anea", "thanedble"]),
    ("kw_attion", "cat_intl_reach", ["attion", "ontion", "au"]),
    ("kw_onre", "cat_intl_reach", ["onre", "de la"]),
    ("kw_erer", "cat_biz_ops", ["erer", "of the"]),
    ("kw_und", "cat_biz_ops", ["und", "der die"]),
    ("kw_thing", "cat_proxy_stack", ["thing"]),
    ("kw_que", "cat_proxy_stack", ["que", "Que!"]),
    ("kw_thou", "misc_other", ["thou"]),
    ("kw_thwh", "cat_missing", ["thwh"]),
]
PHRASES = [
    ("ph_the_er", "The er", 3),
    ("ph_onan", "onan", 2),
    ("ph_erst", "erst", 1),
    ("ph_eres", "eres", 2),
    ("ph_en_la", "en la", 2),
    ("ph_retion", "retion", 1),
]


def word_dictionary(spark: SparkSession) -> Dictionary:
    return Dictionary(
        local_frame(spark, CATEGORIES, "id string, name string, tier int"),
        local_frame(
            spark, [(n, i, c, i, a) for n, (i, c, a) in enumerate(KEYWORDS)],
            "ordinal int, id string, category_id string, canonical string, aliases array<string>",
        ),
        local_frame(
            spark, [(n, i, p, t) for n, (i, p, t) in enumerate(PHRASES)],
            "ordinal int, id string, phrase string, tier int",
        ),
    )


def word_patterns(spark: SparkSession) -> DataFrame:
    return compile_dictionary(word_dictionary(spark))


def _words(text: str) -> str:
    words = text.lower().replace("!", "").split()
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _patterns_sql() -> str:
    tier = {i: t for i, _, t in CATEGORIES}
    weight = {3: "4.0", 2: "2.5", 1: "1.0"}
    phrase_weight = {3: "2.0", 2: "1.2", 1: "0.6"}
    rows, seen = [], set()
    for n, (i, c, aliases) in enumerate(KEYWORDS):
        for k, alias in enumerate(aliases):
            if (i, _words(alias)) in seen:
                continue
            seen.add((i, _words(alias)))
            w = weight[tier[c]] if c in tier else "NULL"
            rows.append(f"('keyword', '{i}', '{c}', {w}, {n * 1000 + k}, {_words(alias)})")
    for n, (i, p, t) in enumerate(PHRASES):
        rows.append(f"('phrase', '{i}', NULL, {phrase_weight[t]}, {n * 1000}, {_words(p)})")
    return (
        "patterns(kind, dict_id, category_id, weight, dict_order, pattern) AS (SELECT col0, col1, "
        "col2, col3::DOUBLE, col4::BIGINT, col5 FROM (VALUES " + ", ".join(rows) + "))"
    )


PATTERNS_SQL = _patterns_sql()

HITS_SQL = (
    OFFERS_SQL + ",\n" + PATTERNS_SQL + ",\n"
    + tokens_sql("title_t", "offers", "offer_id, company_id", "title") + ",\n"
    + tokens_sql("desc_t", "offers", "offer_id, company_id", "description") + """,
field_t AS (
  SELECT offer_id, 'title' AS field, 0 AS field_no, tokens FROM title_t
  UNION ALL SELECT offer_id, 'description', 1, tokens FROM desc_t),
positions AS (
  SELECT *, unnest(range(0, len(tokens))) AS i FROM field_t),
hits AS (
  SELECT offer_id, kind, dict_id, category_id, field, i AS token_index, pattern,
         list_has_any(tokens[greatest(i - 8, 0) + 1 : i], ['no', 'sin', 'not', 'without'])
           OR list_has_any(tokens[i + len(pattern) + 1 : i + len(pattern) + 2],
                           ['no', 'sin', 'not', 'without']) AS is_negated,
         weight * CASE field WHEN 'title' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS points,
         field_no, dict_order
  FROM positions JOIN patterns ON tokens[i + 1] = pattern[1]
   AND tokens[i + 1 : i + len(pattern)] = pattern)"""
)

CATEGORY_SQL = """category_points AS (
  SELECT offer_id, category_id, count(*) AS hit_count, max(points) AS points,
         min((field_no, token_index, dict_order)) AS first_hit
  FROM hits WHERE kind = 'keyword' AND NOT is_negated AND points IS NOT NULL
  GROUP BY ALL)"""

PHRASE_SQL = """phrase_points AS (
  SELECT offer_id, dict_id AS phrase_id, count(*) AS hit_count, max(points) AS points,
         min((field_no, token_index, dict_order)) AS first_hit
  FROM hits WHERE kind = 'phrase' AND NOT is_negated GROUP BY ALL)"""

BUCKETS_SQL = """buckets AS (
  SELECT offer_id,
    coalesce(sum(points) FILTER (WHERE category_id LIKE 'cat@_fx@_%' ESCAPE '@'), 0) AS fx,
    least(coalesce(sum(points) FILTER (WHERE category_id LIKE 'cat@_intl@_%' ESCAPE '@'), 0), 3.0) AS intl,
    least(coalesce(sum(points) FILTER (WHERE category_id LIKE 'cat@_biz@_%' ESCAPE '@'), 0), 2.5) AS biz,
    least(coalesce(sum(points) FILTER (WHERE category_id NOT LIKE 'cat@_fx@_%' ESCAPE '@'
      AND category_id NOT LIKE 'cat@_intl@_%' ESCAPE '@'
      AND category_id NOT LIKE 'cat@_biz@_%' ESCAPE '@'), 0), 1.5) AS proxy
  FROM category_points GROUP BY offer_id)"""

SCORES_SQL = CATEGORY_SQL + ",\n" + PHRASE_SQL + ",\n" + BUCKETS_SQL + """,
phrase_sums AS (
  SELECT offer_id, list_reduce(list(points ORDER BY first_hit), lambda a, b: a + b) AS points
  FROM phrase_points GROUP BY offer_id),
summary AS (
  SELECT offer_id, count(DISTINCT category_id) AS unique_categories,
         count(DISTINCT dict_id) FILTER (WHERE kind = 'keyword') AS unique_keywords,
         count(*) FILTER (WHERE kind = 'keyword' AND is_negated) AS negated_keyword_hits,
         count(*) FILTER (WHERE kind = 'phrase' AND is_negated) AS negated_phrase_hits
  FROM hits GROUP BY offer_id),
tops AS (
  SELECT offer_id, first(category_id ORDER BY points DESC, first_hit) AS top_category_id
  FROM category_points GROUP BY offer_id),
parts AS (
  SELECT o.offer_id, o.company_id, o.published_at,
         coalesce(fx, 0) AS fx_raw, least(coalesce(fx, 0), 7.0) AS fx, coalesce(intl, 0) AS intl,
         coalesce(biz, 0) AS biz, coalesce(proxy, 0) AS proxy,
         coalesce(p.points, 0) AS phrase_points, coalesce(top_category_id, '') AS top_category_id,
         coalesce(unique_categories, 0) AS unique_categories,
         coalesce(unique_keywords, 0) AS unique_keywords,
         coalesce(negated_keyword_hits, 0) AS negated_keyword_hits,
         coalesce(negated_phrase_hits, 0) AS negated_phrase_hits
  FROM offers o LEFT JOIN buckets USING (offer_id) LEFT JOIN phrase_sums p USING (offer_id)
  LEFT JOIN tops USING (offer_id) LEFT JOIN summary USING (offer_id) WHERE o.description IS NOT NULL),
synergies AS (
  SELECT *, fx_raw >= 2.0 AS core,
         CASE WHEN fx_raw >= 2.0 THEN least(
           CASE WHEN intl >= 1.0 THEN 1.0::DOUBLE ELSE 0 END
           + CASE WHEN biz >= 1.0 THEN 0.8::DOUBLE ELSE 0 END, 1.8::DOUBLE) ELSE 0 END AS synergy
  FROM parts),
raws AS (
  SELECT *, CASE WHEN core THEN fx + intl + biz + proxy + phrase_points + synergy
                 ELSE least(fx + intl + biz + proxy + phrase_points + synergy, 5.0) END AS raw_score
  FROM synergies),
scores AS (
  SELECT *, floor(greatest(0, least(10, raw_score)) + 0.5)::DOUBLE AS score FROM raws)"""

COMPANY_METRICS_SQL = """company_metrics AS (
  SELECT company_id, max(score) AS max_score, sum(1 + repost_count)::BIGINT AS offer_count,
         count(*) AS unique_offer_count, count(*) FILTER (WHERE score >= 6) AS strong_offer_count,
         avg(score) FILTER (WHERE score >= 6) AS avg_strong_score,
         first(category_id ORDER BY score DESC, seen_at DESC NULLS LAST, offer_id) AS top_category_id,
         first(offer_id ORDER BY score DESC, seen_at DESC NULLS LAST, offer_id) AS top_offer_id,
         max(seen_at) FILTER (WHERE score >= 6) AS last_strong_at
  FROM scored_offers GROUP BY company_id)"""
