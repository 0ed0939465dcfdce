"""Run state and reports over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import runs
from offerlens.operators.ledger import COUNTERS, run_ledger
from registry import query
from registry.views import table

STATE_SQL = """WITH ev AS (SELECT user_id AS query_key, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, event_id AS seq,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'SUCCESS' ELSE 'RUNNING' END AS event, props AS error
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY ts, seq) AS n FROM ev),
ls AS (SELECT query_key, max(n) AS n FROM r WHERE event = 'SUCCESS' GROUP BY 1),
m AS (SELECT r.*, event = 'ERROR' AND r.n > coalesce(ls.n, 0) AS open FROM r LEFT JOIN ls USING (query_key)),
states AS (SELECT query_key, arg_max(event, n) AS status, max(ts) FILTER (WHERE event = 'RUNNING') AS last_run_at,
  max(ts) FILTER (WHERE event = 'SUCCESS') AS last_success_at, max(ts) FILTER (WHERE event = 'ERROR') AS last_error_at,
  count(*) FILTER (WHERE open) AS failures, arg_max(error, n) FILTER (WHERE open) AS last_error FROM m GROUP BY 1)
"""


def state_events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("query_key"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "SUCCESS")
        .otherwise("RUNNING").alias("event"), F.col("props").alias("error"))


@query("f13_query_state", STATE_SQL + "SELECT * FROM states")
def f13(spark, sf):
    return runs.query_states(state_events(spark, sf))


@query("i7_failing_queries", STATE_SQL + """
SELECT query_key, failures FROM states WHERE failures > 0 ORDER BY failures DESC, query_key LIMIT 20""")
def i7(spark, sf):
    return runs.failing_queries(runs.query_states(state_events(spark, sf)), 20).select("query_key", "failures")


@query("g5_latest_run", STATE_SQL + """
SELECT query_key, ts, seq, event, error FROM r QUALIFY row_number() OVER (PARTITION BY query_key ORDER BY n DESC) = 1""")
def g5(spark, sf):
    return runs.latest_runs(state_events(spark, sf), "query_key")


@query("f14_f11_source_counters", """
SELECT event_type, count(*) AS fetched, count(*) FILTER (WHERE value > 50) AS upserted,
  count(*) FILTER (WHERE value <= 50 AND value > 5) AS skipped, count(*) FILTER (WHERE value <= 5) AS failed
FROM events GROUP BY ROLLUP (event_type)""")
def f14(spark, sf):
    rows = table(spark, sf, "events").select("event_type", F.when(F.col("value") > 50, "upserted").when(
        F.col("value") > 5, "skipped").otherwise("failed").alias("outcome"))
    return runs.outcome_counters(rows, "event_type")


@query("h19_query_key", """
SELECT event_id, 'api:' || event_type || ':' || substr(sha256('{"page":' || (event_id % 7)::VARCHAR || CASE WHEN event_id % 3 > 0 THEN ',"text":"' || event_type || '"' ELSE '' END || ',"user":' || user_id::VARCHAR || '}'), 1, 12) AS query_key FROM events""")
def h19(spark, sf):
    return table(spark, sf, "events").select("event_id", runs.query_key(
        F.lit("api"), F.col("event_type"), F.struct(
            F.col("user_id").alias("user"), F.lit(None).cast("string").alias("sort"), (F.col("event_id") % 7).alias("page"),
            F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("text")),
        ("user", "sort", "page", "text")).alias("query_key"))


@query("f12_c13_pause_report", """
WITH p AS (SELECT user_id AS client, max(ts) AS until FROM events GROUP BY 1),
d AS (SELECT client, epoch(date_trunc('second', until))::BIGINT - epoch(TIMESTAMP '2024-01-29 00:00:00')::BIGINT AS s FROM p)
SELECT client, CASE WHEN s > 0 THEN 'PAUSED' ELSE 'EXPIRED' END AS status, greatest(s, 0) AS seconds_left FROM d""")
def f12(spark, sf):
    pauses = table(spark, sf, "events").groupBy(F.col("user_id").alias("client")).agg(
        F.max("ts").cast("timestamp").alias("paused_until"))
    return runs.pause_report(pauses, F.lit("2024-01-29 00:00:00").cast("timestamp"))


@query("f12_lock_report", """
WITH l AS (SELECT event_type || ':' || user_id::VARCHAR AS lock_name, arg_max(event_id, ts) AS owner_id, date_trunc('second', max(ts)) AS acquired_at FROM events GROUP BY event_type, user_id),
e AS (SELECT *, acquired_at + INTERVAL 15 MINUTE AS expires_at FROM l)
SELECT lock_name, owner_id, CASE WHEN expires_at > TIMESTAMP '2024-01-29 00:00:00' THEN 'ACTIVE' ELSE 'EXPIRED' END AS lock_status,
  epoch(expires_at)::BIGINT - epoch(TIMESTAMP '2024-01-29 00:00:00')::BIGINT AS seconds_until_expiry FROM e""")
def f12_locks(spark, sf):
    """Each user's kind of event as a lock: the last event took it for a quarter of an hour."""
    at = F.date_trunc("second", F.max("ts").cast("timestamp"))
    locks = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.max_by("event_id", "ts").alias("owner_id"), at.alias("acquired_at")).select(
        F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("lock_name"), "owner_id", "acquired_at",
        (F.col("acquired_at") + F.expr("INTERVAL 15 MINUTES")).alias("expires_at"))
    return runs.lock_report(locks, F.lit("2024-01-29 00:00:00").cast("timestamp")).drop("acquired_at", "expires_at")


COUNTED = ("customer", "documents", "events", "pages")


@query("f12_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in COUNTED))
def f12_counts(spark, sf):
    return runs.table_counts({t: table(spark, sf, t) for t in COUNTED})


RUN_SQL = """WITH e AS (SELECT user_id::VARCHAR || '/' || strftime(ts, '%Y-%m-%d') AS run_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS moment,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' ELSE 'running' END AS status FROM events),
r AS (SELECT run_id, moment, status, count(*) AS n FROM e GROUP BY ALL),
runs AS (SELECT run_id, min(moment) FILTER (WHERE status = 'running') AS started_at, max(moment) FILTER (WHERE status <> 'running') AS finished_at,
  coalesce(arg_max(status, moment || status) FILTER (WHERE status <> 'running'), 'running') AS status,
  arg_max(n, moment || status) FILTER (WHERE status <> 'running') AS offers_fetched FROM r GROUP BY 1)
"""


def ledger_rows(spark, sf):
    """A user's day as a run: purchases close it as a success, errors as a failure, all else keeps it open."""
    e = table(spark, sf, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "success").otherwise("running").alias("status"))
    rows = e.groupBy("run_id", "at", "status").agg(F.count(F.lit(1)).alias("offers_fetched"))
    empty = F.lit(None)
    return rows.select("*", *[empty.cast("string").alias(c) for c in ("provider", "query_key", "error")],
                       *[empty.cast("long").alias(c) for c in COUNTERS if c != "offers_fetched"])


@query("b15_run_ledger", RUN_SQL + "SELECT * FROM runs")
def b15(spark, sf):
    return run_ledger(ledger_rows(spark, sf)).select("run_id", "started_at", "finished_at", "status", "offers_fetched")


@query("f12_recent_runs", RUN_SQL + "SELECT * FROM runs ORDER BY started_at DESC NULLS LAST, run_id LIMIT 10")
def f12_runs(spark, sf):
    return runs.recent_runs(run_ledger(ledger_rows(spark, sf)), 10).select("run_id", "started_at", "finished_at", "status", "offers_fetched")


@query("i8_query_states_of_client", STATE_SQL + "SELECT query_key, status FROM states WHERE failures < 3")
def i8(spark, sf):
    return runs.client_states(
        runs.query_states(state_events(spark, sf)),
        F.col("failures") < 3).select("query_key", "status")


@query("i6_feedback_events_newest_first", """
SELECT user_id, event_id, event_type FROM events WHERE event_type IN ('error', 'view', 'click') ORDER BY ts DESC, event_id DESC""")
def i6(spark, sf):
    return table(spark, sf, "events").filter(F.col("event_type").isin("error", "view", "click")).orderBy(
        F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


@query("b16_b17_merged_states", STATE_SQL + "SELECT query_key, status, last_run_at, last_success_at, failures, last_error FROM states")
def b16(spark, sf):
    """The first part of the events is stored as states; the rest is merged in."""
    events = state_events(spark, sf)
    early = F.col("ts") < "2024-01-10"
    stored = runs.query_states(events.filter(early))
    return runs.merge_states(stored, events.filter(~early)).select(
        "query_key", "status", "last_run_at", "last_success_at", "failures", "last_error")
