"""The offer batch ingest over documents, in two batches against a stored company table.

documents are offers, their source is the company. The first batch holds the English and German ones; the second the others, and once
more the long ones of the first, seen a year later. All gates occur: French offers of few characters come without a link, short Spanish
ones without a text, short English ones without a company; a third of the companies is stored already, some of them resolved.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators.ledger import COUNTERS, LEDGER, run_ledger
from offerlens.plans import offer_batch as ob
from offerlens.session import checkpoint_folder, spread
from offerlens.sinks.snapshots import Snapshots
from registry import query
from registry import views as v
from registry.merges import RESOLUTION_SQL
from registry.reposts import FOLD_SQL
from registry.views import table

NUMBER = "CAST(substr(source, 4) AS INTEGER)"
#: Columns of an arriving offer in the words of both engines.
ARRIVAL = {
    "provider": "CASE WHEN lang = 'es' THEN 'lever' ELSE 'infojobs' END",
    "provider_url": "CASE WHEN lang = 'fr' AND n_chars < 900 THEN '  ' ELSE concat('https://x.test/', CAST(doc_id AS VARCHAR(20))) END",
    "company_name": "CASE WHEN lang = 'en' AND n_chars < 400 THEN NULL ELSE concat('Firm ', source, ' S.L.') END",
    "website_url": f"CASE WHEN lang = 'en' AND n_chars < 400 THEN NULL WHEN {NUMBER} % 2 = 0 THEN concat('https://www.', source, '.test/x') END",
    "description": "CASE WHEN lang = 'es' AND n_chars < 500 THEN NULL ELSE text END",
}
FIRST = "lang IN ('en', 'de')"
AGAIN = FIRST + " AND n_chars > 2500"
STORED = f"SELECT DISTINCT source, {NUMBER} AS n FROM documents WHERE {NUMBER} % 3 = 0"
AS_OF = ("2026-01-01T00:00:00Z", "2026-02-01T00:00:00Z")


def arriving(spark, sf, rows, updated):
    docs = spread(table(spark, sf, "documents").filter(rows), "doc_id")
    first_line = F.get(F.split("text", "\n"), F.lit(0))
    made = docs.withColumns({name: F.expr(sql) for name, sql in ARRIVAL.items()}).withColumns({
        "seq": F.col("doc_id"), "provider_offer_id": F.col("doc_id").cast("string"), "title": first_line,
        "published_at": F.lit("2024-01-01"), "updated_at": F.when(F.expr(updated), "2025-01-01")})
    fields = [part.split()[:2] for part in ob.ARRIVING.replace("\n", " ").split(",")]
    return made.select(*[(F.col(k) if k in made.columns else F.lit(None)).cast(t).alias(k) for k, t in fields])


def stored_companies(spark, sf):
    n = F.expr(NUMBER)
    rows = table(spark, sf, "documents").select("source", n.alias("n")).filter("n % 3 = 0").distinct()
    made = rows.withColumns({
        "id": F.col("n") + 1, "normalized_name": F.concat(F.lit("firm "), "source"), "resolution": F.expr(RESOLUTION_SQL.format("n")),
        "website_domain": F.when(F.col("n") % 2 == 0, F.concat("source", F.lit(".test")))})
    columns = spark.createDataFrame([], ob.SCHEMAS["companies"]).schema
    return made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns])


_done: dict[tuple[str, str], tuple[Snapshots, str]] = {}


def ingested(spark, sf) -> tuple[Snapshots, str]:
    """The state after both batches and the ledger; one run in a session serves all queries."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _done:
        folder = f"{checkpoint_folder(spark)}/ingest-{abs(hash(key))}"
        snapshots = Snapshots(spark, f"{folder}/state", ob.SCHEMAS)
        snapshots.commit("seed", {"companies": stored_companies(spark, sf)})
        patterns = v.word_patterns(spark)
        for batch, rows, updated, as_of in (("1", FIRST, "false", AS_OF[0]), ("2", f"NOT ({FIRST}) OR ({AGAIN})", FIRST, AS_OF[1])):
            ob.run_offer_batch(snapshots, f"{folder}/ledger", "infojobs", arriving(spark, sf, rows, updated), patterns, lambda t=as_of: t, batch, batch)
        _done[key] = snapshots, f"{folder}/ledger"
    return _done[key]


SQL = "WITH RECURSIVE arrivals AS (SELECT *, " + ", ".join(f"{sql} AS x_{name}" for name, sql in ARRIVAL.items()) + f""",
    split_part(text, chr(10), 1) AS title, lower(concat('firm ', source)) AS name FROM documents),
sent AS (SELECT *, CASE WHEN {FIRST} THEN 1 ELSE 2 END AS batch, false AS again FROM arrivals
  UNION ALL SELECT *, 2, true FROM arrivals WHERE {AGAIN}),
known AS ({STORED}),
early AS (SELECT *, (batch - 1) * 1000000000 + doc_id AS a, CASE WHEN trim(x_provider_url) = '' THEN 'missing_provider_url'
  WHEN x_provider = 'lever' AND coalesce(trim(x_description), '') = '' THEN 'missing_description'
  WHEN x_company_name IS NULL THEN 'company_unidentifiable' END AS early FROM sent),
firms AS (SELECT source, (n + 1)::BIGINT AS id, {RESOLUTION_SQL.format('n')} AS resolution FROM known
  UNION ALL SELECT source, (SELECT max(n + 1) FROM known) + row_number() OVER (ORDER BY min(a)), 'PENDING' FROM early
    WHERE early IS NULL AND source NOT IN (SELECT source FROM known) GROUP BY source),
judged AS (SELECT e.*, f.id AS firm, coalesce(early, CASE WHEN resolution IN ('ALREADY_REVOLUT', 'ACCEPTED', 'REJECTED') THEN 'company_resolved' END) AS gate
  FROM early e LEFT JOIN firms f ON f.source = e.source AND e.early IS NULL),
offers AS (SELECT a AS offer_id, firm AS company_id, title, x_description AS description, '2024-01-01' AS published_at FROM judged WHERE gate IS NULL),
""" + v.tokens_sql("title_t", "offers", "offer_id, company_id", "title") + ",\n" + v.tokens_sql("desc_t", "offers", "offer_id, company_id", "description") + """,
keyed AS (SELECT o.offer_id, o.company_id, o.published_at AS seen_at, t.tokens AS title_tokens, d.tokens AS desc_tokens,
    trim(title, E' \\t\\n\\r') <> '' AS has_title, coalesce(trim(description, E' \\t\\n\\r') <> '', false) AS has_desc,
    CASE WHEN len(t.tokens) > 0 AND len(d.tokens) > 0 THEN sha256(array_to_string(t.tokens, chr(10)) || chr(10) || chr(10)
      || array_to_string(d.tokens, chr(10))) END AS fingerprint
  FROM offers o JOIN title_t t USING (offer_id) JOIN desc_t d USING (offer_id)),
""" + FOLD_SQL + """,
first_sent AS (SELECT j.*, f.canonical_id AS c FROM judged j JOIN folded f ON f.offer_id = a WHERE NOT again),
ids AS (SELECT a, doc_id, row_number() OVER (ORDER BY a) AS id FROM first_sent WHERE c IS NULL),
outcomes AS (SELECT j.*, CASE WHEN gate IS NOT NULL THEN gate WHEN again AND o.id IS NOT NULL THEN 'updated' WHEN f.canonical_id IS NULL THEN 'inserted'
    ELSE 'repost_duplicate' END AS outcome, o.id AS own, c.id AS canonical
  FROM judged j LEFT JOIN folded f ON f.offer_id = j.a LEFT JOIN ids o ON o.doc_id = j.doc_id LEFT JOIN ids c ON c.a = f.canonical_id),
events AS (SELECT CASE WHEN outcome = 'repost_duplicate' THEN canonical ELSE own END AS id, a, outcome,
    CASE WHEN again THEN '2025-01-01' ELSE '2024-01-01' END AS seen FROM outcomes WHERE gate IS NULL),
offer_state AS (SELECT id AS offer_id, count(*) FILTER (WHERE outcome = 'repost_duplicate') AS repost_count, arg_max(seen, a) AS last_seen_at,
    max(CASE WHEN outcome = 'updated' THEN 2 ELSE 1 END) AS updates FROM events GROUP BY id),
stored_offers AS (SELECT i.id AS offer_id, j.doc_id, j.firm AS company_id, s.repost_count, s.last_seen_at, k.fingerprint, j.x_description AS description,
    CASE WHEN s.updates = 2 OR j.batch = 2 THEN '""" + AS_OF[1] + "' ELSE '" + AS_OF[0] + """' END AS last_updated_at,
    '2024-01-01' AS published_at
  FROM ids i JOIN judged j ON j.a = i.a JOIN offer_state s ON s.offer_id = i.id JOIN keyed k ON k.offer_id = i.a)
"""


@query("k1_offers", SQL + """SELECT offer_id, doc_id::VARCHAR AS provider_offer_id, company_id, repost_count, last_seen_at, last_updated_at,
  fingerprint AS content_fingerprint FROM stored_offers""")
def k1_offers(spark, sf):
    return ingested(spark, sf)[0].read("offers").select(
        "offer_id", "provider_offer_id", "company_id", "repost_count", "last_seen_at", "last_updated_at", "content_fingerprint")


SCORED = SQL.rstrip() + ",\n" + v.PATTERNS_SQL + ",\n" + v.HITS_SQL[v.HITS_SQL.index("field_t AS ("):] + ",\n" + v.SCORES_SQL


@query("k1_matches", SCORED + """
SELECT o.offer_id, score, top_category_id FROM stored_offers o JOIN ids i ON i.id = o.offer_id JOIN scores s ON s.offer_id = i.a WHERE o.description IS NOT NULL""")
def k1_matches(spark, sf):
    return ingested(spark, sf)[0].read("matches").select(
        "offer_id", "score", F.get_json_object("matched_keywords_json", "$.topCategoryId").alias("top_category_id"))


@query("k1_companies", SCORED + """,
scored_offers AS (SELECT o.offer_id, o.company_id, coalesce(s.score, 0) AS score, s.top_category_id AS category_id, o.published_at AS seen_at, o.repost_count
  FROM stored_offers o JOIN ids i ON i.id = o.offer_id LEFT JOIN scores s ON s.offer_id = i.a AND o.description IS NOT NULL),
""" + v.COMPANY_METRICS_SQL + """,
touched AS (SELECT DISTINCT firm FROM outcomes WHERE outcome IN ('inserted', 'updated', 'repost_duplicate', 'company_resolved'))
SELECT f.id, concat('firm ', f.source) AS normalized_name, CASE WHEN CAST(substr(f.source, 4) AS INTEGER) % 2 = 0 THEN f.source || '.test' END AS website_domain,
  f.resolution, CASE WHEN t.firm IS NOT NULL THEN coalesce(m.max_score, 0) END AS max_score, CASE WHEN t.firm IS NOT NULL THEN coalesce(m.offer_count, 0) END AS offer_count,
  CASE WHEN t.firm IS NOT NULL THEN coalesce(m.unique_offer_count, 0) END AS unique_offer_count,
  CASE WHEN t.firm IS NOT NULL THEN coalesce(m.strong_offer_count, 0) END AS strong_offer_count, round(m.avg_strong_score, 9) AS avg_strong_score,
  m.top_category_id, m.top_offer_id, m.last_strong_at
FROM firms f LEFT JOIN touched t ON t.firm = f.id LEFT JOIN company_metrics m ON m.company_id = f.id""")
def k1_companies(spark, sf):
    return ingested(spark, sf)[0].read("companies").select(
        "id", "normalized_name", "website_domain", "resolution", "max_score", "offer_count", "unique_offer_count", "strong_offer_count",
        F.round("avg_strong_score", 9).alias("avg_strong_score"), "top_category_id", "top_offer_id", "last_strong_at")


@query("k1_counters", SQL + """SELECT batch::VARCHAR AS query_key, 'success' AS status, count(*) AS offers_fetched,
  count(*) FILTER (WHERE outcome IN ('inserted', 'updated')) AS offers_upserted, count(*) FILTER (WHERE outcome = 'repost_duplicate') AS offers_duplicates,
  count(*) FILTER (WHERE gate IS NOT NULL) AS offers_skipped, 0::BIGINT AS offers_failed,
  count(*) FILTER (WHERE outcome = 'missing_description') AS offers_skipped_missing_description,
  count(*) FILTER (WHERE outcome = 'repost_duplicate') AS offers_skipped_repost_duplicate,
  count(DISTINCT firm) FILTER (WHERE gate IS NULL OR gate = 'company_resolved') AS affected_companies,
  count(DISTINCT firm) FILTER (WHERE gate IS NULL OR gate = 'company_resolved') AS companies_aggregated, 0::BIGINT AS companies_failed
FROM outcomes GROUP BY batch""")
def k1_counters(spark, sf):
    rows = run_ledger(spark.read.schema(LEDGER).parquet(ingested(spark, sf)[1]))
    return rows.select("query_key", "status", *COUNTERS)


@query("k1_outcomes", SQL + """SELECT doc_id AS seq, outcome, CASE WHEN outcome IN ('inserted', 'updated') THEN own END AS offer_id,
  CASE WHEN outcome = 'repost_duplicate' THEN canonical END AS canonical_id FROM outcomes WHERE batch = 2""")
def k1_outcomes(spark, sf):
    """Outcomes of the last batch, whose offers meet the stored ones of the first."""
    return ingested(spark, sf)[0].read("outcomes").select("seq", "outcome", "offer_id", "canonical_id")
