"""Quality rules: text counts, and lines that many documents of one host share.

Lines are normalised (A-Z lower-cased, digits to 0 in words without a letter, white space collapsed) and hashed. A line of at
least ``min_docs`` distinct documents of a host is boilerplate there, however large the host, if at least ``min_line_words`` of its
words hold a letter: what people say in few words ("I do not know."), rows of numbers and dates are common in any large host
without being boilerplate. Such a line is taken out: ``keep_good``
returns texts without such lines, ``removed_spans`` the byte ranges (each with its line feed) that go. A caller may ask
for a ``share`` of the host's distinct documents as well. A document is depleted, and rejected, when fewer than
``min_words`` words or less than ``min_left`` of its words are left. Exact copies of a text count as one
document, so a page that was crawled often does not turn into boilerplate.

A null or empty text has no words and fails the base rule; a null host is a host of its own; repeated
rows are judged alike; an empty table gives an empty result. Only the named columns are read, so
further columns, whatever their names, do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MIN_LINE_WORDS = 8
SLICE = 1 << 18

FOLD = c.LOWER.copy()
FOLD[48:58] = 48
IS_LETTER = np.arange(256) >= 128
IS_LETTER[65:91] = IS_LETTER[97:123] = True
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))

SCHEMA = ("doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, text_hash long, "
          "lines array<struct<line:long,words:long,spans:array<struct<start:int,stop:int>>>>")

SPANS = "array<struct<start:int,stop:int>>"

#: Places of a row's bit in the filter of touched rows: 2**12 slots of 2**7 words of 64 bits.
SLOT, WORD, BIT = "__row & 4095", "CAST(shiftright(__row, 12) & 127 AS INT)", "shiftleft(1L, CAST(shiftright(__row, 19) & 63 AS INT))"


def _sum(row: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weight, n).astype(np.int64)


def _repeats(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Words that lie in a window found twice or more in their text."""
    h, at, first = c.windows(hashes, row, WINDOW, short=False)
    if not len(h):
        return np.zeros(n, np.int64)
    _, inverse, count = np.unique(h + c.mix(at.astype(np.uint64) + c.STEP[0]), return_inverse=True, return_counts=True)
    first = first[count[inverse] > 1]
    edge = np.zeros(len(hashes) + WINDOW + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + WINDOW, -1)
    return _sum(row[np.cumsum(edge)[: len(hashes)] > 0], n)


def text_counts(data: np.ndarray, offsets: np.ndarray, min_line_words: int = MIN_LINE_WORDS) -> dict:
    """Counts of each row, its text hash, and its distinct normalised lines (of enough words with a letter) with their words and the spans of all their places."""
    n = len(offsets) - 1
    start, end, row = c.word_spans(data, offsets)
    raw, folded = c.prefix_hash(data), c.prefix_hash(data, FOLD)
    code_point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbol = np.concatenate([[0], np.cumsum(IS_SYMBOL[data])])
    out = {
        "n_words": _sum(row, n), "word_chars": _sum(row, n, code_point[end] - code_point[start]),
        "n_symbols": symbol[offsets[1:]] - symbol[offsets[:-1]],
        "n_repeat_words": _repeats(c.span_hash(raw, start, end), row, n),
        "text_hash": c.signed(c.span_hash(raw, offsets[:-1], offsets[1:])),
    }
    # lines: bounded by line feeds and by the ends of texts
    feeds = np.flatnonzero(data == 10)
    opens = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], feeds + 1]))
    opens = opens[opens < len(data)]
    line = np.searchsorted(opens, start, "right") - 1  # of each word
    used, words = np.unique(line, return_counts=True)
    at = np.searchsorted(offsets, opens[used], "right") - 1
    feed = np.searchsorted(feeds, opens[used])
    close = np.minimum(np.append(feeds, len(data))[feed], offsets[at + 1])
    exact = c.span_hash(raw, opens[used], close) + c.mix(at.astype(np.uint64) + c.STEP[1])
    _, first = np.unique(exact, return_index=True)
    out["n_dup_lines"] = _sum(at, n) - _sum(at[first], n)
    # lines that may count, normalised: the sequence of a line's folded words
    letter = np.concatenate([[0], np.cumsum(IS_LETTER[data], dtype=np.int32)])
    lettered = letter[end] > letter[start]
    enough = np.bincount(line, lettered, len(opens))[used] >= min_line_words
    used, words, at, close = used[enough], words[enough], at[enough], close[enough]
    up, down = c.powers(len(start) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(lettered, c.span_hash(c.prefix_hash(data, c.LOWER), start, end), c.span_hash(folded, start, end)) * up[:-1])])
    begin = np.searchsorted(line, used)
    norm = c.mix((sums[begin + words] - sums[begin]) * down[begin] + words.astype(np.uint64))
    _, first, inverse = np.unique(norm + c.mix(at.astype(np.uint64) + c.STEP[2]), return_index=True, return_inverse=True)
    total = np.bincount(inverse, words, len(first)).astype(np.int64)
    order = np.argsort(at[first], kind="stable")
    pick = first[order]
    # places in the order of the picked lines; a span is counted from its text's start and holds the line feed
    rank = np.empty(len(first), np.int64)
    rank[order] = np.arange(len(first))
    place = np.argsort(rank[inverse], kind="stable")
    spans = (np.concatenate([[0], np.cumsum(np.bincount(rank[inverse], minlength=len(first)))]),
             (opens[used] - offsets[at])[place], (np.minimum(close + 1, offsets[at + 1]) - offsets[at])[place])
    out["lines"] = (np.concatenate([[0], np.cumsum(_sum(at[pick], n))]), c.signed(norm[pick]), total[order], spans)
    return out


def _measure(min_line_words):
    def run(batches):
        for batch in batches:
            ids, host = batch.column("doc_id"), batch.column("host")
            for first, data, offsets in c.text_slices(batch.column("text"), SLICE):
                n = len(offsets) - 1
                got = text_counts(data, offsets, min_line_words)
                at, line, words, (places, begin, stop) = got.pop("lines")
                spans = pa.ListArray.from_arrays(places.astype(np.int32), pa.StructArray.from_arrays([pa.array(begin.astype(np.int32)), pa.array(stop.astype(np.int32))], ["start", "stop"]))
                lines = pa.ListArray.from_arrays(at.astype(np.int32), pa.StructArray.from_arrays([pa.array(line), pa.array(words), spans], ["line", "words", "spans"]))
                columns = {"doc_id": ids.slice(first, n), "host": host.slice(first, n)}
                columns |= {k: pa.array(got[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text_hash")}
                yield pa.RecordBatch.from_pydict(columns | {"lines": lines})

    return run


def judge_spans(
    docs: DataFrame, host: str = "source", min_docs: int = 20, share: float = 0.0,
    min_words: int = MIN_WORDS, min_left: float = 0.3, min_line_words: int = MIN_LINE_WORDS,
) -> DataFrame:
    """One row per document with its counts, the words taken out, base_failed, kept, and removed_spans."""
    picked = docs.select(
        F.col("doc_id").cast("long"), F.when(F.col(host).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(host))).alias("host"), "text")
    measured = c.written(c.map_batches(picked, _measure(min_line_words), SCHEMA).withColumn("row", F.monotonically_increasing_id()))
    held = measured.select("row", "host", "text_hash", F.inline("lines"))
    common = held.select("host", "line", "text_hash").distinct().groupBy("host", "line").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs)
    if share > 0:
        of_host = measured.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
        common = common.join(of_host, "host").filter(F.col("docs") >= share * F.col("host_docs"))
    taken = held.join(common.select("host", "line"), ["host", "line"]).groupBy("row").agg(
        F.sum("words").alias("removed_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("removed_spans"))
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = (F.col("removed_words") > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))
    return (
        measured.drop("lines").join(taken, "row", "left").fillna(0, ["removed_words"])
        .withColumn("removed_spans", F.coalesce("removed_spans", F.array().cast(SPANS)))
        .withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words", "host", "text_hash", "removed_spans")
    )


def judge_lines(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """``judge_spans`` without the spans."""
    return judge_spans(docs, host, **limits).drop("removed_spans")


def without(text: str, spans: list[dict]) -> str:
    """The text without byte ranges that are sorted and do not overlap."""
    data, out, at = text.encode(), [], 0
    for span in spans:
        out.append(data[at: span["start"]])
        at = span["stop"]
    return b"".join([*out, data[at:]]).decode()


def _cut(batches):
    for whole in batches:
        for first, _, offsets in c.text_slices(whole.column("text"), SLICE):
            batch = whole.slice(first, len(offsets) - 1)
            text, spans = batch.column("text").to_pylist(), batch.column("__spans").to_pylist()
            done = pa.array([without(t, s) if s else t for t, s in zip(text, spans)], pa.string())
            columns = {n: batch.column(n) for n in batch.schema.names if n != "__spans"} | {"text": done}
            if "n_chars" in columns:
                size = [len(t) if s else n for t, s, n in zip(done.to_pylist(), spans, columns["n_chars"].to_pylist())]
                columns["n_chars"] = pa.array(size, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def row_filter(rows: DataFrame) -> DataFrame:
    """__slot, __words: a bit table of at most 4 MB, at any size of the input, that holds every __row of ``rows``; it may hold others, too."""
    words = rows.groupBy(F.expr(SLOT).alias("__slot"), F.expr(WORD).alias("word")).agg(F.bit_or(F.expr(BIT)).alias("bits"))
    every = words.groupBy("__slot").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bits"))
    return every.selectExpr("__slot", "transform(sequence(0, 127), w -> coalesce(bits[w], 0L)) AS __words")


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The documents that are kept, their texts without the common lines, with all their columns, in no particular order.

    A column ``n_chars`` is the length of the new text where lines were taken out. Only the texts that a bit table lets
    through, which are those that go or lose lines and few others, meet their verdicts in a join; the others stay where they are.
    """
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.col("source"), F.lit("-")), F.coalesce(F.col("text"), F.lit(""))]
    docs = docs.withColumn("text", F.col("text").cast("string"))
    marked = docs.withColumn("__row", F.xxhash64(*key))
    source = marked.select(F.col("__row").alias("doc_id"), "source", "text")
    touched = c.written(judge_spans(source, **limits).filter(~F.col("kept") | (F.col("removed_words") > 0)).groupBy(F.col("doc_id").alias("__row")).agg(
        F.first("kept").alias("__kept"), F.first("removed_spans").alias("__spans")))
    placed = marked.withColumn("__slot", F.expr(SLOT)).join(F.broadcast(c.written(row_filter(touched.select("__row")))), "__slot", "left")
    asked = F.coalesce(F.expr(f"__words[{WORD}] & {BIT}") != 0, F.lit(False))
    judged = placed.filter(asked).drop("__slot", "__words").join(touched, "__row", "left").filter(F.coalesce("__kept", F.lit(True))).drop("__row", "__kept")
    return placed.filter(~asked).select(*docs.columns).unionByName(c.map_batches(judged, _cut, docs.schema))
