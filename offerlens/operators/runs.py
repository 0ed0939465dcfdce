"""Run ledger, query state and operational reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.constants import QUERY_KEY_HEX


def query_key(client: Column, name: Column, params: Column, fields: tuple[str, ...] | None = None) -> Column:
    """client:name:hash of the parameters as JSON with sorted keys, nulls dropped.

    ``params`` is a map of one value type, or with ``fields`` a struct of those
    fields, whose numbers and booleans keep their JSON form.
    """
    if fields is None:
        kept = F.map_filter(params, lambda _, v: v.isNotNull())
        text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))
    else:
        text = F.to_json(F.struct(*[params.getField(f).alias(f) for f in sorted(fields)]))
    return F.concat_ws(":", client, name, F.substring(F.sha2(text, 256), 1, QUERY_KEY_HEX))


def query_states(events: DataFrame) -> DataFrame:
    """State per key from (query_key, ts, seq, event, error) with event in
    RUNNING, SUCCESS, ERROR: last status and times, failures since the last
    success. Two combinable aggregations, no per-key event list."""
    at = F.struct("ts", "seq")
    tagged = events.withColumn("at", at)
    last_success = tagged.filter("event = 'SUCCESS'").groupBy("query_key").agg(
        F.max("at").alias("success_at"))
    later = tagged.join(last_success, "query_key", "left")
    error = F.col("event") == "ERROR"
    open_error = error & (F.col("success_at").isNull() | (F.col("at") > F.col("success_at")))
    return later.groupBy("query_key").agg(
        F.max_by("event", "at").alias("status"),
        F.max(F.when(F.col("event") == "RUNNING", F.col("ts"))).alias("last_run_at"),
        F.max("success_at.ts").alias("last_success_at"),
        F.max(F.when(error, F.col("ts"))).alias("last_error_at"),
        F.count_if(open_error).alias("failures"),
        F.max_by("error", F.when(open_error, F.col("at"))).alias("last_error"))


def merge_states(stored: DataFrame, events: DataFrame) -> DataFrame:
    """Stored states after further events: the state of all events so far.

    Failures start anew after a success among the new events, else they add
    up; a stored error text stays until a success or a newer error.
    """
    names = ["status", "last_run_at", "last_success_at", "last_error_at", "failures", "last_error"]
    new = query_states(events).select("query_key", F.struct(*names).alias("new"))
    old = stored.select("query_key", F.struct(*names).alias("old"))
    success = F.col("new.last_success_at").isNotNull()
    latest = [F.coalesce(f"new.{c}", f"old.{c}").alias(c) for c in names[:4]]
    zero = F.lit(0).cast("long")
    return old.join(new, "query_key", "full_outer").select(
        "query_key", *latest,
        F.when(success, F.col("new.failures")).otherwise(
            F.coalesce("old.failures", zero) + F.coalesce("new.failures", zero)).alias("failures"),
        F.when(success, F.col("new.last_error")).otherwise(
            F.coalesce("new.last_error", "old.last_error")).alias("last_error"))


def failing_queries(states: DataFrame, k: int) -> DataFrame:
    return states.filter("failures > 0").orderBy(F.desc("failures"), "query_key").limit(k)


def latest_runs(runs: DataFrame, key: str) -> DataFrame:
    rest = [c for c in runs.columns if c != key]
    return runs.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("ts", "seq")).alias("r")).select(key, "r.*")


def outcome_counters(rows: DataFrame, group: str) -> DataFrame:
    """Per group and in total (null group): fetched, upserted, skipped, failed."""
    return rows.rollup(group).agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("outcome") == "upserted").alias("upserted"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(F.col("outcome") == "failed").alias("failed"))


def pause_report(pauses: DataFrame, now: Column) -> DataFrame:
    """Pause rows with status and seconds left."""
    left = F.unix_timestamp("paused_until") - F.unix_timestamp(now)
    return pauses.select(
        "client", F.when(left > 0, "PAUSED").otherwise("EXPIRED").alias("status"),
        F.greatest(left, F.lit(0).cast("long")).alias("seconds_left"))


def lock_report(locks: DataFrame, now: Column) -> DataFrame:
    """(lock_name, owner_id, acquired_at, expires_at) with lock_status and the seconds until (negative: since) the expiry."""
    return locks.select(
        "lock_name", "owner_id", "acquired_at", "expires_at",
        F.when(now < F.col("expires_at"), "ACTIVE").otherwise("EXPIRED").alias("lock_status"),
        (F.unix_timestamp("expires_at") - F.unix_timestamp(now)).alias("seconds_until_expiry"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n): rows of each table, in one plan; an empty table counts 0."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, counts)


def recent_runs(ledger: DataFrame, k: int) -> DataFrame:
    """The ``k`` runs of a ledger that started last; ties by run_id."""
    return ledger.orderBy(F.desc_nulls_last("started_at"), "run_id").limit(k)


def client_states(states: DataFrame, client: Column | None = None) -> DataFrame:
    rows = states if client is None else states.filter(client)
    return rows.orderBy("query_key")
