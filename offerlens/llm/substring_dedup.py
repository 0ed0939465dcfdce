"""Substring dedup by de Bruijn compaction.

A k-mer is ``WINDOW`` consecutive words of one document: an edge of the de Bruijn graph from the node of its first ``WINDOW - 1``
words to that of its last. An edge is repeated if it has two source coordinates (row, word) or more; the
words that repeated edges cover are removed. Edges are never shuffled one by one where a path of them will do:

1. Every edge has an anchor, the smallest hash of its ``ANCHOR``-word runs (leftmost on ties), which equal edges share wherever
   they stand. Consecutive edges of a text with one anchor are a path, some 14 edges. Anchors are counted over all texts;
   paths whose anchor occurs once hold no repeated edge and go.
2. The others are cut from their texts at their source coordinates: end nodes, edge hashes, and a digest (blake2b) of the path's
   words themselves. Paths that agree in anchor and digest are one path of the graph with several sources: all
   its edges are repeated. A path with one source is taken apart, and its edges are counted with those of all distinct
   paths of their anchor.
3. Compaction: repeated paths are joined on their end nodes; a node with one path in and one out does not branch, and the paths
   on both sides belong together. Connected components of these links are the compacted paths.
4. Back at the source coordinates, a document's neighbouring pieces of one compacted path are merged to long spans.

Every exchange is keyed by anchor, edge, node or row, combines before it or is a many-to-one join, which the skew
join splits; so a passage in a third of all documents costs no task more than others. Lists are collected for one document
only, and are no longer than its text. Edges count as equal if 64 bits of the anchor and 64 of the edge agree.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts have no words and give empty texts; texts with fewer than ``WINDOW``
words stay. Rows are told apart by doc_id (null counts as -1) and a hash of the text; a repeated row is
another document, so its words of a window's length or more are removed in both. An empty table gives an empty result.
Other columns stay; ``n_words`` and ``n_removed`` of the input are replaced.
"""

from __future__ import annotations

from hashlib import blake2b
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm import common as c
from offerlens.llm import graphs

WINDOW, ANCHOR = 35, 8
#: Low bits of a packed anchor hold its place in the slice, so that the leftmost wins a tie.
PLACE = np.uint64((1 << 30) - 1)
SLICE = 4 << 20
SEEN = 1_000_000


class Words:
    """Word hashes of a slice of texts and the hashes of any runs of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        start, end, self.row = c.word_spans(data, offsets)
        h = c.span_hash(c.prefix_hash(data), start, end)
        up, self.down = c.powers(len(h) + 1)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[:-1], out=self.sums[1:])
        #: the first word of each row, and the number of words at the end
        self.base = np.searchsorted(self.row, np.arange(len(offsets)))

    def hashes(self, at: np.ndarray, size) -> np.ndarray:
        return c.mix((self.sums[at + size] - self.sums[at]) * self.down[at] + np.asarray(size, np.uint64))

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first word and number of edges of each path."""
        n, row = len(self.row), self.row
        nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if n < WINDOW:
            return nothing
        edge = np.flatnonzero(row[: n - WINDOW + 1] == row[WINDOW - 1:])
        if not len(edge):
            return nothing
        grams = self.hashes(np.arange(n - ANCHOR + 1), ANCHOR)
        low = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        reach, width = WINDOW - ANCHOR + 1, 1
        while 2 * width <= reach:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[edge], low[edge + reach - width])
        fresh = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        return grams[(low[fresh] & PLACE).astype(np.int64)], edge[fresh], np.diff(np.append(fresh, len(edge)))


def _anchors(batches):
    for batch in batches:
        for _, data, offsets in c.text_slices(batch.column("text"), SLICE):
            anchor, times = np.unique(Words(data, offsets).paths()[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c.signed(anchor)), pa.array(times)], ["anchor", "times"])


def _places(batches):
    for batch in batches:
        for first, data, offsets in c.text_slices(batch.column("text"), SLICE):
            words = Words(data, offsets)
            anchor, start, n = words.paths()
            row = words.row[start]
            take = pa.array(first + row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(take), batch.column("__key").take(take), pa.array(c.signed(anchor)),
                 pa.array((start - words.base[row]).astype(np.int32)), pa.array(n.astype(np.int32))], ["__id", "__key", "anchor", "start", "n"])


PATH = "__id long, __key long, start int, n int, anchor long, path long, tail long, head long, edges binary"


def _paths(batches):
    """The paths at the given coordinates of each text, with a digest of their words as ``path``, nodes and edges.

    A task sends nodes and edges of a path with its first source only (of the first ``SEEN`` paths).
    """
    seen: set[int] = set()
    for batch in batches:
        text, lists = batch.column("text"), batch.column("places")
        for first, data, offsets in c.text_slices(text, SLICE):
            words = Words(data, offsets)
            part = lists.slice(first, len(offsets) - 1)
            places = part.flatten()
            row = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
            start, n = places.field("start").to_numpy(), places.field("n").to_numpy().astype(np.int64)
            at = words.base[row] + start
            bounds = np.concatenate([[0], np.cumsum(n)])
            edge = words.hashes(np.repeat(at - bounds[:-1], n) + np.arange(bounds[-1]), WINDOW)
            path, raw, owner = np.zeros(len(row), np.int64), [], -1
            for k, (r, s, m) in enumerate(zip(row.tolist(), start.tolist(), n.tolist())):
                if r != owner:
                    raw, owner = data[offsets[r]: offsets[r + 1]].tobytes().split(), r
                path[k] = int.from_bytes(blake2b(b" ".join(raw[s: s + m + WINDOW - 1]), digest_size=8).digest(), "little", signed=True)
            again = np.zeros(len(row), bool)
            for k, one in enumerate(path.tolist()):
                again[k] = one in seen
                if len(seen) < SEEN:
                    seen.add(one)
            kept = np.where(again, 0, n)
            edge = edge[np.repeat(~again, n)]
            edges = pc.if_else(pa.array(again), pa.scalar(None, pa.binary()), _binaries(edge, np.concatenate([[0], np.cumsum(kept)])))
            take = pa.array(first + row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(take), batch.column("__key").take(take), pa.array(start), pa.array(n.astype(np.int32)), places.field("anchor"),
                 pa.array(path), pa.array(c.signed(words.hashes(at, WINDOW - 1)), mask=again),
                 pa.array(c.signed(words.hashes(at + n, WINDOW - 1)), mask=again), edges],
                ["__id", "__key", "start", "n", "anchor", "path", "tail", "head", "edges"])


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = (bounds * 8).astype(np.int64)
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])
    return whole.cast(pa.binary())


def _single_edges(batches):
    """One row of each edge of a path."""
    for batch in batches:
        edges = batch.column("edges")
        size = np.array([len(e.as_buffer()) // 8 for e in edges], np.int64)
        raw = b"".join(e.as_buffer().to_pybytes() for e in edges)
        take = pa.array(np.repeat(np.arange(len(size)), size))
        step = np.arange(len(take)) - np.repeat(np.cumsum(size) - size, size)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k).take(take) for k in ("__id", "__key", "start", "anchor", "times")), pa.array(step.astype(np.int32)),
             pa.array(np.frombuffer(raw, np.int64))], ["__id", "__key", "start", "anchor", "times", "step", "edge"])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the two columns that tell rows apart."""
    return docs.withColumn("text", F.col("text").cast("string")).withColumn(
        "__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long"))).withColumn("__key", F.xxhash64("text"))


def source_paths(texts: DataFrame) -> DataFrame:
    """PATH rows of all paths whose anchor occurs twice or more. ``texts``: __id, __key, text."""
    # written, so that the join below has no aggregate on its side and a frequent anchor can be split
    often = c.written(c.map_batches(texts.select("text"), _anchors, "anchor long, times long").groupBy("anchor").agg(
        F.sum("times").alias("times")).filter("times > 1").select("anchor"))
    c.release(texts.sparkSession)
    places = c.map_batches(texts, _places, "__id long, __key long, anchor long, start int, n int").join(often, "anchor")
    by_row = c.written(places.groupBy("__id", "__key").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("places")))
    c.release(texts.sparkSession)
    return c.written(c.map_batches(texts.join(by_row, ["__id", "__key"]).select("__id", "__key", "text", "places"), _paths, PATH))


def compacted(paths: DataFrame) -> DataFrame:
    """path, root: repeated paths that follow one another without a branch get one root.

    ``paths``: path, tail, head, and __id of a source, one row for each path of the graph. Links are dealt by that source, as
    neighbouring paths mostly have the same one: a task then contracts whole runs before any round.
    """
    into = paths.groupBy(F.col("head").alias("node")).agg(F.count("*").alias("n"), F.max(F.struct("path", "__id")).alias("a")).filter("n = 1")
    out = paths.groupBy(F.col("tail").alias("node")).agg(F.count("*").alias("n"), F.max("path").alias("b")).filter("n = 1")
    links = into.select("node", "a").join(out.select("node", "b"), "node").select("a.__id", F.col("a.path").alias("a"), "b")
    return graphs.components(links.repartition("__id").select("a", "b")).withColumnRenamed("node", "path")


def repeated_pieces(sources: DataFrame) -> DataFrame:
    """__id, __key, start, n, span: runs of repeated edges; equal spans tell which compacted path a run lies on (null: none)."""
    same = ["anchor", "path"]
    paths = c.written(sources.groupBy(*same).agg(
        F.count("*").alias("times"), F.min(F.struct("__id", "__key", "start")).alias("s"), F.max("edges").alias("edges"),
        F.min("tail").alias("tail"), F.min("head").alias("head")).select(*same, "times", "s.*", "edges", "tail", "head"))
    c.release(sources.sparkSession)
    repeated = paths.filter("times > 1")
    groups = c.written(compacted(repeated.select("__id", "path", "tail", "head")))
    named = repeated.select(*same).join(groups, "path", "left").withColumn("span", F.coalesce("root", "path")).drop("root")
    whole = sources.select("__id", "__key", "start", "n", *same).join(named, same).select("__id", "__key", "start", "n", "span")
    columns = ["__id", "__key", "start", "anchor", "times", "edges"]
    every, own = (c.map_batches(p.select(*columns), _single_edges, "__id long, __key long, start int, anchor long, times long, step int, edge long")
                  for p in (paths, paths.filter("times = 1")))
    often = c.written(every.groupBy("anchor", "edge").agg(F.sum("times").alias("all"), F.min("times").alias("least")).filter(
        "all > 1 AND least = 1").select("anchor", "edge"))
    c.release(sources.sparkSession)
    single = own.join(often, ["anchor", "edge"]).select(
        "__id", "__key", (F.col("start") + F.col("step")).alias("start"), F.lit(1).alias("n"), F.lit(None).cast("long").alias("span"))
    return whole.union(single)


def long_spans(pieces: DataFrame) -> DataFrame:
    """Pieces of one row and compacted path that touch, merged: __id, __key, start, n, span."""
    order = Window.partitionBy("__id", "__key", "span").orderBy("start", "n")
    end = F.max(F.col("start") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = pieces.withColumn("opens", F.when(F.col("start") <= end, 0).otherwise(1))
    run = opened.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("__id", "__key", "span", "run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("end")).select(
        "__id", "__key", "start", (F.col("end") - F.col("start")).cast("int").alias("n"), "span")


def _spans(docs: DataFrame) -> DataFrame:
    pieces = c.written(repeated_pieces(source_paths(docs.select("__id", "__key", "text"))))
    c.release(docs.sparkSession)
    spans = c.written(long_spans(pieces))
    c.release(docs.sparkSession)
    return spans


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id (-1: null), start, n_words, span: where passages stand that occur elsewhere, in words; equal spans are one passage or parts of it."""
    return _spans(keyed(docs)).select(F.col("__id").alias("doc_id"), "start", (F.col("n") + WINDOW - 1).alias("n_words"), "span").distinct()


def _cut(names):
    def run(batches):
        for batch in batches:
            texts, sizes, gone = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("__spans")):
                words = (text.as_py() or "").encode().split()
                spans = spans.as_py() or []
                if spans:
                    keep = np.ones(len(words), bool)
                    for span in spans:
                        keep[span["start"]: span["start"] + span["n"] + WINDOW - 1] = False
                    left = list(compress(words, keep.tolist()))
                else:
                    left = words
                texts.append(b" ".join(left).decode())
                sizes.append(len(words))
                gone.append(len(words) - len(left))
            columns = [pa.array(texts, pa.string()) if k == "text" else batch.column(k) for k in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())], [*names, "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept words, joined by single spaces, as ``text``, and n_words (before) and n_removed."""
    rows = keyed(docs)
    by_row = _spans(rows).groupBy("__id", "__key").agg(F.collect_list(F.struct("start", "n")).alias("__spans"))
    names = [k for k in docs.columns if k not in ("n_words", "n_removed")]
    joined = rows.join(by_row, ["__id", "__key"], "left").select(*names, "__spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    return c.map_batches(joined, _cut(names), f"{fields}, n_words long, n_removed long")
