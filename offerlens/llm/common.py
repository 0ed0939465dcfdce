"""Shared helpers: the shared folder, Arrow text slices, and word hashes in numpy."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = tuple(np.uint64(x) for x in _rng.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1))

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder that the cluster names.

    Only a local session (tests, a laptop) without ``spark.checkpoint.dir`` gets a temporary one; on a cluster its executors would
    each write to a disk of their own, so it is an error there.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark, path, schema = df.sparkSession, shared_folder(df.sparkSession), df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Free shuffle files of tables that nothing refers to any more.

    Spark removes them when the driver collects its garbage, which a driver with little to do may not do
    for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def row_key(df: DataFrame, *names: str):
    """A column that tells rows apart by their content: hash of the named columns."""
    return F.xxhash64(*[F.col(n) for n in names])


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes.

    A text is never cut; a null text counts as empty. Offsets start at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; a process keeps those of a slice, those of longer texts go with them."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (BASE, BASE_INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps, out=steps))
    if n <= SLICE_BYTES + 1:
        _powers[:] = made
    return made[0], made[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_hash(data: np.ndarray, fold: np.ndarray = IDENTITY) -> np.ndarray:
    """Running sums from which ``span_hash`` reads the hash of any byte range."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[fold][data] * up[:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges; equal ranges give equal values wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that are not ASCII white space."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opens = offsets[:-1][offsets[:-1] < len(data)]
    first[opens] |= inside[opens]
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    closes = offsets[1:][offsets[1:] > 0] - 1
    last[closes] |= inside[closes]
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


def windows(hashes: np.ndarray, row: np.ndarray, width: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of each run of ``width`` words inside one row.

    With ``short``, a row of fewer words gives its whole sequence as one window.
    """
    n = len(hashes)
    if n >= width:
        whole = np.flatnonzero(row[: n - width + 1] == row[width - 1:])
        h = np.zeros(len(whole), np.uint64)
        for k in range(width):
            h += hashes[whole + k] * STEP[k]
    else:
        whole, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = mix(h)
    at = row[whole]
    if short and n:
        count = np.bincount(row)
        few = np.flatnonzero((count > 0) & (count < width))
        if len(few):
            begin = np.searchsorted(row, few)
            rest = np.zeros(len(few), np.uint64)
            for k in range(width - 1):
                has = count[few] > k
                rest[has] += hashes[begin[has] + k] * STEP[k]
            rest = mix(rest + count[few].astype(np.uint64))
            h, at, whole = np.concatenate([h, rest]), np.concatenate([at, few]), np.concatenate([whole, begin])
            order = np.argsort(at, kind="stable")
            h, at, whole = h[order], at[order], whole[order]
    return h, at, whole


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


_kept: dict[str, object] = {}


def kept(key: str, make: Callable[[], object]):
    """What ``make`` returns, kept by this worker process for later tasks that ask for the same."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def let_go(keep: str | None = None) -> None:
    """Workers outlive their tasks: what other work kept in this process goes, and freed Arrow memory is returned."""
    for key in [k for k in _kept if k != keep]:
        del _kept[key]
    pa.default_memory_pool().release_unused()


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType, keep: str | None = None,
) -> DataFrame:
    """``fn`` over the Arrow batches of each task; ``keep``: the key of what it asks ``kept`` for."""
    def run(batches):
        let_go(keep)
        yield from fn(batches)

    return df.mapInArrow(run, schema)
