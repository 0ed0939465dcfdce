"""Token ids in ORC files: run-length encoded integers, row indexes and Bloom filters on document ids.

Documents are put in ascending order of their id by a range exchange, encoded, and written one sorted file
per task: doc_id, the file's number, the ids before the document in its file, its token count and its ids.
Integer columns are run-length encoded by ORC; the row index (a minimum and maximum every ``ROW_STRIDE``
rows) and the Bloom filter let a reader skip row groups and stripes that cannot hold an id, and stripes
are read in parallel. A global start is a file's base, a running sum over one row per file, plus the
place inside the file, so no task sees the whole corpus.

A null text is empty and holds just the end id. Null ids come first; rows of equal id are ordered by
the hash of their text, repeated rows keep their copies. An empty table gives files without rows. Other
columns are not read.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm import common as c
from offerlens.llm.bpe import byte_characters

ROW_STRIDE = 1000
SLICE = 3 << 20
KNOWN_WORDS = 600_000
#: ASCII marks: a run of them after a letter is a piece of its own.
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
MARK = np.isin(np.arange(256), list(MARKS))
#: Letters below are composed and have one lower-case form for both Python and the library.
LATIN_END = "\u0250"
STORED = "doc_id long, file int, before long, n_tokens long, ids array<int>"

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


class WordEncoder(dict):
    """The tokenizers library, with the ids of words seen before.

    The vocabulary drops white space and none of its rules reach across it, so the ids of a text are
    those of its words. A word of lower-cased Latin letters is left alone by the normaliser and is one piece
    for the pre-tokeniser, so it goes to the library's BPE model at once; all other words go through the
    whole tokenizer.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.characters = {b: ch for ch, b in byte_characters().items()}

    def __missing__(self, key: bytes) -> bytes:
        word = key.decode()
        low = word.lower()
        if low.isalpha() and max(low) < LATIN_END:
            mapped = low if low.isascii() else low.encode().decode("latin-1").translate(self.characters)
            ids = array("i", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        else:
            core = key.rstrip(MARKS)
            # the letter before the marks stays one when it is lowered (a capital dotted I leaves a combining dot, which goes with the marks)
            if b"<|" not in key and len(core) < len(key) and core.decode()[-1:].isalpha() and core.decode().lower()[-1:].isalpha():
                ids = self[core] + self[key[len(core):]]
            else:
                ids = array("i", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(key) <= 64:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[key] = ids
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, and how many each row has.

        Every distinct word of the slice is looked up once. The run of marks after an ASCII letter is a word of
        its own, and upper-case ASCII letters are lower-case ones, but for slices with special tokens and before a byte
        that is not ASCII: a combining character there is composed with the letter first, in its own case.
        """
        n = len(offsets) - 1
        start, end, row = c.word_spans(data, offsets)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        raw = data.tobytes()
        plain = b"<|" not in raw
        low = data
        if plain:
            low = c.LOWER[data]
            wide = np.flatnonzero(data[1:] >= 128)
            low[wide] = data[wide]
        stop = np.maximum.accumulate(np.where(MARK[data], -1, np.arange(len(data))))[end - 1] + 1
        tail = (stop < end) & (stop > start) & LETTER[data[np.maximum(stop - 1, 0)]] & plain
        stop = np.where(tail, stop, end)
        place = np.arange(len(start)) + np.cumsum(tail) - tail
        first, last, at = (np.empty(len(start) + int(tail.sum()), np.int64) for _ in range(3))
        first[place], last[place], at[place] = start, stop, row
        marks = place[tail] + 1
        first[marks], last[marks], at[marks] = stop[tail], end[tail], row[tail]
        _, one, number = np.unique(c.span_hash(c.prefix_hash(low), first, last), return_index=True, return_inverse=True)
        if plain:
            raw = low.tobytes()
        found = [self[raw[x:y]] for x, y in zip(first[one].tolist(), last[one].tolist())]
        size = np.array([len(x) for x in found]) // 4
        table, begin = np.frombuffer(b"".join(found), np.int32), np.cumsum(size) - size
        many = size[number]
        return table[np.repeat(begin[number] - (np.cumsum(many) - many), many) + np.arange(many.sum())], np.bincount(at, many, n).astype(np.int64)


_encoders: dict[int, WordEncoder] = {}


def write_tokens(docs: DataFrame, vocabulary_path: str, path: str, end_id: int = 1, files: int | None = None) -> None:
    """Encode whole texts and write them below ``path`` in ascending doc_id order."""
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = hash(shared.value)
        if key not in _encoders:
            _encoders[key] = WordEncoder(shared.value)
        encoder = _encoders[key]
        number, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, data, offsets in c.text_slices(batch.column("text"), SLICE):
                ids, counts = encoder.encode(data, offsets)
                n = len(counts)
                # each row's ids, then the end id
                out = np.full(len(ids) + n, end_id, np.int32)
                out[np.arange(len(ids)) + np.repeat(np.arange(n), counts)] = ids
                counts += 1
                bounds = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(np.full(n, number, np.int32)), pa.array(before + bounds[:-1]), pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(out))],
                    ["doc_id", "file", "before", "n_tokens", "ids"])
                before += int(bounds[-1])

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = picked.repartitionByRange(files, "doc_id") if files else picked.repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    c.map_batches(ordered, run, STORED).write.options(**{
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
        "orc.row.index.stride": str(ROW_STRIDE), "orc.compress": "ZSTD"}).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Stored documents; filters on doc_id reach the stripes' indexes and Bloom filters."""
    return spark.read.schema(STORED).orc(path)


def file_bases(spark: SparkSession, path: str) -> DataFrame:
    """file, base: ids in all files before; reads one column and makes one row per file."""
    sizes = read_tokens(spark, path).groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))


def _digest(batches):
    for batch in batches:
        ids = batch.column("ids")
        offsets = np.asarray(ids.offsets)
        data = memoryview(np.asarray(ids.values).astype("<u4").tobytes())
        crc = [zlib.crc32(data[4 * a: 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("file"), batch.column("before"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "file", "before", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    rows = c.map_batches(read_tokens(spark, path).select("doc_id", "file", "before", "ids"), _digest,
                         "doc_id long, file int, before long, n_tokens long, ids_crc32 long")
    return rows.join(file_bases(spark, path), "file").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
