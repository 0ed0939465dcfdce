import os
import random

import pytest
from pyspark.sql import functions as F

from offerlens.operators import runs
from offerlens.plans import offer_batch as ob
from offerlens.sinks.snapshots import Snapshots
from offerlens.streaming.continuous import ingest_job, run_per_batch, suppress_repeats
from offerlens.streaming.query_state import status_stream
from tests.test_offer_batch import FIRST, offers
from tests.test_rules import small_dictionary


def test_batches_without_repeats(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(f"2024-01-01 00:00:{i % 50:02d}", "p", str(i % 30)) for i in range(60)]
    spark.createDataFrame(rows, "t string, provider string, provider_offer_id string").select(
        F.col("t").cast("timestamp").alias("ts"), "provider", "provider_offer_id").write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, provider string, provider_offer_id string").parquet(source)

    def job(batch, number):
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={number}"))

    run_per_batch(suppress_repeats(stream, "ts", "10 minutes"), job, str(tmp_path / "cp")).awaitTermination(60)
    got = spark.read.parquet(out).select("provider_offer_id").collect()
    assert sorted(int(r[0]) for r in got) == list(range(30))


def files(frame, folder, parts):
    """One file per part, in the order in which a file stream reads them."""
    for k, part in enumerate(parts):
        frame.filter(part).coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            if name.startswith("part-"):
                os.rename(f"{folder}/{name}", f"{folder}/file-{k}.parquet")
                os.utime(f"{folder}/file-{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))


def test_a_stream_of_batches_equals_one_batch(spark, tmp_path):
    frame = offers(spark, FIRST)
    patterns = small_dictionary(spark, [("cat_fx_a", 0)], ("dollar",))
    files(frame, str(tmp_path / "in"), ["seq < 2", "seq BETWEEN 2 AND 6", "seq > 6"])
    stream = spark.readStream.schema(ob.ARRIVING).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streamed, whole = (Snapshots(spark, f"{tmp_path}/{k}", ob.SCHEMAS) for k in ("streamed", "whole"))
    job = ingest_job(streamed, str(tmp_path / "ledger"), "infojobs", patterns, lambda: "2024-06-01", "s")
    seen = []

    def twice(batch, number):
        job(batch, number)
        version = streamed.latest()["version"]
        if number == 1:  # as after a failure between the commit and the stream's own mark
            job(batch, number)
        seen.append((number, version, streamed.latest()["version"]))

    query = run_per_batch(stream, twice, str(tmp_path / "cp"))
    query.awaitTermination(600)
    assert seen == [(0, 1, 1), (1, 2, 2), (2, 3, 3)]
    ob.run_offer_batch(whole, str(tmp_path / "ledger2"), "infojobs", frame, patterns, lambda: "2024-06-01", "all")
    for name in ("companies", "company_sources", "offers", "matches"):
        a, b = (sorted(s.read(name).collect(), key=str) for s in (streamed, whole))
        assert a == b, name


@pytest.mark.parametrize("delay,spread", [("60 days", 40), ("2 hours", 1)])
def test_streamed_states_equal_the_batch_fold(spark, tmp_path, delay, spread):
    rng = random.Random(spread)
    rows = []
    for n in range(240):
        at = n // 8 if spread == 1 else rng.randrange(40 * 24)  # hours; all late beyond order, or in order
        ts = f"2024-01-{1 + at // 24:02d}T{at % 24:02d}:00:00" if at < 31 * 24 else f"2024-02-{1 + at // 24 - 31:02d}T{at % 24:02d}:00:00"
        rows.append((f"k{rng.randrange(7)}", ts, n, rng.choice(["RUNNING", "ERROR", "ERROR", "SUCCESS"]), f"e{n}" if n % 5 else None, n // 60))
    frame = spark.createDataFrame(rows, "query_key string, ts string, seq long, event string, error string, part int").withColumn(
        "event_time", F.to_timestamp("ts"))
    files(frame, str(tmp_path / "in"), [f"part = {k}" for k in range(4)])
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    states = {}

    def keep(batch, number):
        for r in batch.collect():
            states[r.query_key] = r

    query = status_stream(stream, delay).writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    want = {r.query_key: r for r in runs.query_states(frame).collect()}
    assert {k: tuple(r) for k, r in states.items()} == {
        k: (k, r.status, r.last_run_at, r.last_success_at, r.last_error_at, r.failures, r.last_error) for k, r in want.items()}
