"""Session helpers shared by the operators."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def build_session(app: str = "offerlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) without one gets a fresh temporary folder; elsewhere it is an error, as
    executors would write to disks of their own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


RELEASE_S = 5.0
_released = 0.0


def release(spark: SparkSession, every: float | None = None) -> bool:
    """Let go of the shuffle files that nothing refers to any more, and of the driver's memory for finished plans; at most every so many seconds.

    Spark removes shuffle files when the driver collects its garbage, which a driver with little to do may not do for
    long: the files of all steps would lie on the disks together, and its heap would grow to its limit.
    """
    global _released
    now = time.monotonic()
    if now - _released < (RELEASE_S if every is None else every):
        return False
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _released = time.monotonic()
    return True


_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def _written(df: DataFrame) -> str:
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release(df.sparkSession)
    return path


def _read(df: DataFrame, path: str) -> DataFrame:
    tables = _tables.get()
    if tables is not None:
        tables.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized(df: DataFrame) -> DataFrame:
    """Write a table to the checkpoint folder and read it back; what only its making needed is released.

    The optimizer then knows its size in bytes: it broadcasts the table below
    the session's threshold and shuffles it beyond.
    """
    return _read(df, _written(df))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized inside are removed at the end: nothing that reads them may leave the block unwritten."""
    paths: list[str] = []
    token = _tables.set(paths)
    try:
        yield
    finally:
        _tables.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialized_result(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()``, materialized; the tables on the way to it are removed."""
    with scratch(spark):
        df = make()
        path = _written(df)
    return _read(df, path)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a local relation (known size, no Python task)."""
    struct = T._parse_datatype_string(schema)
    data = pa.table(
        [pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(struct)],
        names=struct.names,
    )
    return spark.createDataFrame(data, schema=struct)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core for inputs that arrive in fewer splits than there are cores.

    Large inputs already have more splits than cores and pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df
