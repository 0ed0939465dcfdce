"""Text, dictionary, matching, scoring and company queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.functions.text import normalize_tokens, remove_diacritics
from offerlens.operators import companies, dictionary, matching, scoring
from registry import query
from registry import views as v
from registry.views import table, with_sql


def _offers(spark, sf):
    return v.document_offers(spark, sf)


def _hits(spark, sf):
    return matching.match_offers(_offers(spark, sf), v.word_patterns(spark), "offer_id")


def _scores(spark, sf):
    offers = scoring.with_description(_offers(spark, sf))
    return scoring.score_offers(matching.match_offers(offers, v.word_patterns(spark), "offer_id"), offers, "offer_id")


@query("h1_normalize_tokens", with_sql(
    v.OFFERS_SQL, v.tokens_sql("t", "offers", "offer_id", "description")) + """
SELECT offer_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::BIGINT AS n_tokens FROM t""")
def h1(spark, sf):
    return _offers(spark, sf).select(
        "offer_id", normalize_tokens(F.col("description")).alias("t")
    ).select("offer_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("long").alias("n_tokens"))


@query("h2_remove_diacritics", """
SELECT doc_id, strip_accents(lower(text)) AS plain FROM documents""")
def h2(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", remove_diacritics(F.lower("text")).alias("plain"))


@query("d1_d2_dictionary_hits", with_sql(v.HITS_SQL) + """
SELECT offer_id, kind, dict_id, category_id, field, token_index::BIGINT AS token_index,
       array_to_string(pattern, ' ') AS matched, is_negated FROM hits""")
def d1_d2(spark, sf):
    return _hits(spark, sf).select(
        "offer_id", "kind", "dict_id", "category_id", "field",
        F.col("token_index").cast("long").alias("token_index"),
        F.array_join("matched_tokens", " ").alias("matched"), "is_negated")


@query("d3_match_summary", with_sql(v.HITS_SQL) + """
SELECT offer_id, count(*) FILTER (WHERE kind = 'keyword') AS keyword_hits,
       count(*) FILTER (WHERE kind = 'phrase') AS phrase_hits,
       count(DISTINCT category_id) AS unique_categories,
       count(DISTINCT dict_id) FILTER (WHERE kind = 'keyword') AS unique_keywords
FROM hits GROUP BY offer_id""")
def d3(spark, sf):
    return matching.match_summary(_hits(spark, sf), "offer_id")


@query("c10_c14_negation", with_sql(v.HITS_SQL) + """
SELECT dict_id, count(*) AS hits, count(*) FILTER (WHERE is_negated) AS negated,
       count(*) FILTER (WHERE NOT is_negated) AS active FROM hits GROUP BY dict_id""")
def c10(spark, sf):
    return _hits(spark, sf).groupBy("dict_id").agg(
        F.count(F.lit(1)).alias("hits"), F.count_if("is_negated").alias("negated"),
        F.count_if(~F.col("is_negated")).alias("active"))


@query("f1_category_contribution", with_sql(v.HITS_SQL, v.CATEGORY_SQL) + """
SELECT offer_id, category_id, hit_count, points FROM category_points""")
def f1(spark, sf):
    return scoring.category_contributions(_hits(spark, sf), "offer_id").drop("first_hit")


@query("f2_phrase_contribution", with_sql(v.HITS_SQL, v.PHRASE_SQL) + """
SELECT offer_id, phrase_id, hit_count, points FROM phrase_points""")
def f2(spark, sf):
    return scoring.phrase_contributions(_hits(spark, sf), "offer_id").drop("first_hit")


@query("e4_hits_with_known_tier", with_sql(v.HITS_SQL) + """
SELECT category_id, field, count(*) AS hits, sum(points) AS points FROM hits
WHERE kind = 'keyword' AND points IS NOT NULL GROUP BY ALL""")
def e4(spark, sf):
    return (
        _hits(spark, sf).filter("kind = 'keyword' AND points IS NOT NULL")
        .groupBy("category_id", "field")
        .agg(F.count(F.lit(1)).alias("hits"), F.sum("points").alias("points"))
    )


@query("i3_ranked_contributions", with_sql(v.HITS_SQL, v.CATEGORY_SQL) + """
SELECT offer_id, string_agg(category_id, ',' ORDER BY points DESC, first_hit) AS ranked
FROM category_points GROUP BY offer_id""")
def i3(spark, sf):
    scores = _scores(spark, sf)
    return scores.filter(F.size("categories") > 0).select(
        "offer_id", F.array_join("categories.category_id", ",").alias("ranked"))


SCORE_COLUMNS = """offer_id, score, top_category_id, round(raw_score, 6) AS raw_score, core,
  NOT core AS no_core_cap, synergy, fx::DOUBLE AS direct_fx, intl::DOUBLE AS intl_footprint,
  biz::DOUBLE AS business_model, proxy::DOUBLE AS tech_proxy,
  unique_categories::BIGINT AS unique_categories, unique_keywords::BIGINT AS unique_keywords,
  negated_keyword_hits::BIGINT AS negated_keyword_hits,
  negated_phrase_hits::BIGINT AS negated_phrase_hits"""


@query("k8_score_offers", with_sql(v.HITS_SQL, v.SCORES_SQL) + f"SELECT {SCORE_COLUMNS} FROM scores")
def k8(spark, sf):
    return _scores(spark, sf).select(
        "offer_id", "score", "top_category_id", F.round("raw_score", 6).alias("raw_score"),
        "core", "no_core_cap", "synergy", "direct_fx", "intl_footprint", "business_model",
        "tech_proxy", "unique_categories", "unique_keywords", "negated_keyword_hits",
        "negated_phrase_hits")


@query("f3_f4_buckets_and_synergy", with_sql(v.HITS_SQL, v.SCORES_SQL) + """
SELECT core, synergy, count(*) AS offers, sum(fx)::DOUBLE AS direct_fx,
       sum(intl)::DOUBLE AS intl_footprint, sum(biz)::DOUBLE AS business_model,
       sum(proxy)::DOUBLE AS tech_proxy FROM scores GROUP BY core, synergy""")
def f3_f4(spark, sf):
    scores = _scores(spark, sf)
    return scores.groupBy("core", "synergy").agg(
        F.count(F.lit(1)).alias("offers"),
        *[F.sum(c).alias(c) for c in ("direct_fx", "intl_footprint", "business_model", "tech_proxy")])


@query("f5_score_histogram", with_sql(v.HITS_SQL, v.SCORES_SQL) + """
SELECT score, count(*) AS offers FROM scores GROUP BY score""")
def f5(spark, sf):
    scores = _scores(spark, sf)
    return scores.groupBy("score").agg(F.count(F.lit(1)).alias("offers"))


@query("f6_top_category", with_sql(v.HITS_SQL, v.SCORES_SQL) + """
SELECT offer_id, top_category_id FROM scores""")
def f6(spark, sf):
    return _scores(spark, sf).select(
        "offer_id", "top_category_id")


def _scored_documents(spark, sf):
    offers = _offers(spark, sf)
    scores = _scores(spark, sf)
    return offers.join(scores, "offer_id", "left").select(
        "offer_id", "company_id", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("top_category_id", F.lit("")).alias("category_id"),
        "published_at", F.lit(None).cast("string").alias("updated_at"),
        F.lit(None).cast("long").alias("canonical_offer_id"),
        F.lit(0).cast("long").alias("repost_count"))


SCORED_DOCUMENTS_SQL = """scored_offers AS (
  SELECT o.offer_id, o.company_id, coalesce(score, 0) AS score, coalesce(top_category_id, '') AS category_id, o.published_at AS seen_at,
         0 AS repost_count FROM offers o LEFT JOIN scores USING (offer_id))"""
METRIC_COLUMNS = ("max_score", "offer_count", "unique_offer_count", "strong_offer_count",
                  "avg_strong_score", "top_category_id", "top_offer_id", "last_strong_at")


@query("company_ranking", with_sql(
    v.HITS_SQL, v.SCORES_SQL, SCORED_DOCUMENTS_SQL, v.COMPANY_METRICS_SQL) + f"""
SELECT company_id, {', '.join(METRIC_COLUMNS)} FROM company_metrics""")
def company_ranking(spark, sf):
    return companies.aggregate_companies(_scored_documents(spark, sf)).select(
        "company_id", *METRIC_COLUMNS)


# --- companies from customer and orders ---------------------------------------


def order_offers(spark, sf):
    """orders as scored offers of customers; lineitem gives the repost count."""
    reposts = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"))
    orders = table(spark, sf, "orders")
    return orders.join(reposts, orders.o_orderkey == reposts.l_orderkey, "left").select(
        F.col("o_orderkey").alias("offer_id"), F.col("o_custkey").alias("company_id"),
        F.least(F.lit(10.0), F.floor(F.col("o_totalprice") / 40000).cast("double")).alias("score"),
        F.col("o_orderpriority").alias("category_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        F.lit(None).cast("string").alias("updated_at"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey")).alias("canonical_offer_id"),
        F.coalesce("n", F.lit(0).cast("long")).alias("repost_count"))


ORDER_OFFERS_SQL = """reposts AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
scored_all AS (
  SELECT o_orderkey AS offer_id, o_custkey AS company_id,
         least(10.0, floor(o_totalprice / 40000))::DOUBLE AS score, o_orderpriority AS category_id,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS seen_at,
         CASE WHEN o_orderstatus = 'P' THEN o_orderkey END AS canonical_offer_id,
         coalesce(n, 0) AS repost_count
  FROM orders LEFT JOIN reposts ON o_orderkey = l_orderkey),
scored_offers AS (SELECT * FROM scored_all WHERE canonical_offer_id IS NULL)"""


@query("f7_company_aggregate", with_sql(ORDER_OFFERS_SQL, v.COMPANY_METRICS_SQL) + f"""
SELECT company_id, {', '.join(METRIC_COLUMNS)} FROM company_metrics""")
def f7(spark, sf):
    return companies.aggregate_companies(order_offers(spark, sf)).select(
        "company_id", *METRIC_COLUMNS)


@query("f8_category_max_map", with_sql(ORDER_OFFERS_SQL) + """
SELECT company_id, string_agg(category_id || '=' || best::BIGINT, ';' ORDER BY category_id) AS entries
FROM (SELECT company_id, category_id, max(score) AS best FROM scored_offers GROUP BY ALL)
WHERE best > 0 GROUP BY company_id""")
def f8(spark, sf):
    m = companies.aggregate_companies(order_offers(spark, sf))
    return m.filter(F.size("category_max_scores") > 0).select("company_id", F.array_join(
        F.transform(F.array_sort(F.map_entries("category_max_scores")),
                    lambda e: F.concat_ws("=", e.key, e.value.cast("long").cast("string"))), ";",
    ).alias("entries"))


@query("f9_f10_affected_companies", with_sql(ORDER_OFFERS_SQL, v.COMPANY_METRICS_SQL) + """
SELECT c_custkey AS company_id, coalesce(max_score, 0) AS max_score,
       coalesce(offer_count, 0) AS offer_count, coalesce(unique_offer_count, 0) AS unique_offer_count,
       coalesce(strong_offer_count, 0) AS strong_offer_count, avg_strong_score, top_category_id,
       top_offer_id, last_strong_at
FROM customer LEFT JOIN company_metrics ON c_custkey = company_id WHERE c_acctbal > 0""")
def f9_f10(spark, sf):
    touched = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("company_id"))
    return companies.aggregate_affected(order_offers(spark, sf), touched).select(
        "company_id", *METRIC_COLUMNS)


@query("g3_top_offer", with_sql(ORDER_OFFERS_SQL) + """
SELECT company_id, offer_id, score, seen_at FROM scored_offers
QUALIFY row_number() OVER (PARTITION BY company_id
  ORDER BY score DESC, seen_at DESC NULLS LAST, offer_id) = 1""")
def g3(spark, sf):
    rows = order_offers(spark, sf).filter("canonical_offer_id IS NULL")
    best = F.max_by(F.struct("offer_id", "score", F.col("published_at").alias("seen_at")),
                    F.struct("score", "published_at", -F.col("offer_id")))
    return rows.groupBy("company_id").agg(best.alias("b")).select("company_id", "b.*")


@query("i5_company_ranking_top", with_sql(ORDER_OFFERS_SQL, v.COMPANY_METRICS_SQL) + """
SELECT c_custkey AS id, max_score FROM customer LEFT JOIN company_metrics ON c_custkey = company_id
ORDER BY max_score DESC NULLS LAST, id LIMIT 100""")
def i5(spark, sf):
    metrics = companies.aggregate_companies(order_offers(spark, sf))
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    joined = ids.join(metrics, ids.id == metrics.company_id, "left").select("id", "max_score")
    return companies.rank_companies(joined, 100)


# --- dictionary from part -------------------------------------------------------


def part_dictionary(spark, sf):
    """part as a dictionary: brands are categories, parts keywords, types phrases."""
    part = table(spark, sf, "part")
    categories = part.groupBy(F.col("p_brand").alias("id")).agg(
        F.max("p_name").alias("name"), (F.max("p_size") % 4).alias("tier"))
    keywords = part.select(
        F.col("p_partkey").cast("int").alias("ordinal"),
        F.concat(F.lit("kw"), F.floor(F.col("p_partkey") / 3).cast("string")).alias("id"),
        F.when(F.col("p_size") == 50, "Brand#none").otherwise(F.col("p_brand")).alias("category_id"),
        F.when(F.col("p_size") == 49, " ").otherwise(F.col("p_name")).alias("canonical"),
        F.array(F.col("p_name"), F.upper("p_name"), F.col("p_type")).alias("aliases"))
    phrases = part.groupBy(F.col("p_type").alias("id")).agg(
        F.min("p_partkey").cast("int").alias("ordinal"), F.max("p_name").alias("phrase"),
        (F.min("p_size") % 4).alias("tier")).select("ordinal", "id", "phrase", "tier")
    return dictionary.Dictionary(categories, keywords, phrases)


@query("a10_dictionary_compile", """
WITH kw AS (SELECT 'kw' || (p_partkey // 3)::VARCHAR AS dict_id,
    CASE WHEN p_size = 50 THEN 'Brand#none' ELSE p_brand END AS category_id,
    unnest([lower(p_name), lower(p_type)]) AS pattern FROM part),
ph AS (SELECT p_type AS dict_id, lower(max(p_name)) AS pattern FROM part GROUP BY 1)
SELECT DISTINCT 'keyword' AS kind, dict_id, category_id, pattern,
       len(string_split(pattern, ' '))::BIGINT AS n_tokens FROM kw
UNION ALL SELECT 'phrase', dict_id, NULL, pattern, len(string_split(pattern, ' '))::BIGINT FROM ph""")
def a10(spark, sf):
    return dictionary.compile_dictionary(part_dictionary(spark, sf)).select(
        "kind", "dict_id", "category_id", F.array_join("pattern", " ").alias("pattern"),
        F.col("n_tokens").cast("long").alias("n_tokens"))


@query("a11_e11_dictionary_violations", """
WITH cat AS (SELECT p_brand AS id, max(p_size) % 4 AS tier FROM part GROUP BY 1),
kw AS (SELECT 'kw' || (p_partkey // 3)::VARCHAR AS id, p_size,
    CASE WHEN p_size = 50 THEN 'Brand#none' ELSE p_brand END AS category_id FROM part),
ph AS (SELECT p_type AS id, min(p_size) % 4 AS tier FROM part GROUP BY 1)
SELECT 'bad_tier' AS rule, 'category' AS kind, id AS entry_id FROM cat WHERE tier NOT IN (1, 2, 3)
UNION ALL SELECT 'bad_tier', 'phrase', id FROM ph WHERE tier NOT IN (1, 2, 3)
UNION ALL SELECT 'blank_canonical', 'keyword', id FROM kw WHERE p_size = 49
UNION ALL SELECT 'duplicate_id', 'keyword', id FROM kw GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'unknown_category', 'keyword', id FROM kw
  WHERE category_id NOT IN (SELECT id FROM cat)""")
def a11(spark, sf):
    return dictionary.validate_dictionary(part_dictionary(spark, sf))
