"""Embedding near-duplicates by NN-descent.

Vectors are compared within their label only, by cosine in double precision. Equal vectors of a label are one node that
counts as often as it occurs. Every node has a list of its nearest nodes so far:

1. Start: nodes are sorted by the sign bits of random projections (``TABLES`` times, and once more for each doubling of the
   largest space beyond ``LEAF`` nodes), and runs of ``LEAF`` neighbours in that order are compared.
2. Rounds of neighbours-of-neighbours joins: each node gathers its neighbours and a hashed sample of the nodes that have it as
   neighbour, and compares what it gathered among itself; better neighbours enter the lists of both.
3. Audit: a hashed sample of nodes, and one node of each of as many connected pieces, is compared with all nodes. The recall
   is the mean over the sampled nodes that have links, all nodes of one piece counting as one. While it is below ``RECALL``
   another round runs with lists twice as long (to ``LEAF``) and new tables; after ``ROUNDS`` rounds the query fails.
4. Lists of nodes whose every neighbour is beyond the threshold are saturated: there may be more. All nodes of a connected
   piece of threshold edges are then compared with all others of the piece, in blocks, so a list is as long as
   the piece and holds every link inside it. Only counts leave the blocks, never pairs.

Kept edges form the components. Vectors that are null, empty, zero or hold null or non-finite numbers, and rows without a label, link
with nothing and are components of their own. Vectors of unequal length do not link. Rows of one vec_id count as rows;
a component is named by its smallest non-null vec_id. An empty table gives an empty result. Only the three
named columns are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.llm import common as c
from offerlens.llm import graphs

NEAR = 0.98
LIST = 8
TABLES, LEAF, CODE_BITS = 4, 64, 30
ROUNDS, RECALL, AUDITED = 10, 0.99, 1024
BLOCK = 512
VECTOR = T.ArrayType(T.DoubleType())
BESTS = "node long, other long, cosine double"


def unit_rows(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors of one length, scaled to unit length in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    return flat / np.sqrt((flat * flat).sum(1))[:, None]


def usable(embedding):
    """Whether a vector can link: not null or empty, all numbers finite, not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """node (the first of the rows with that vector), space (label and length), vector, times."""
    good = vectors.filter(F.col("label").isNotNull() & usable(F.col("embedding")))
    return good.groupBy("label", "embedding").agg(F.min("row").alias("node"), F.count("*").alias("times")).select(
        "node", F.struct("label", F.size("embedding").alias("width")).alias("space"), F.col("embedding").alias("vector"), "times")


def tables_for(largest: int) -> int:
    return TABLES + max(0, int(largest - 1).bit_length() - int(LEAF - 1).bit_length())


def _codes(tables: int, salt: int):
    """A row per node and table: sign bits of random projections of the unit vector."""

    def run(batches):
        yield from _coded(batches, tables, salt)

    return run


def _coded(batches, tables: int, salt: int):
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(CODE_BITS)[::-1]
    for batch in batches:
        width = np.array([w["width"] for w in batch.column("space").to_pylist()])
        for w in np.unique(width).tolist():
            if w not in planes:
                planes[w] = np.random.default_rng([w, salt]).normal(size=(w, tables * CODE_BITS))
            part = batch.filter(pa.array(width == w))
            unit = unit_rows(part.column("vector"), w)
            signs = (unit @ planes[w] > 0).reshape(len(unit), tables, CODE_BITS)
            codes = (signs * weights).sum(2)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unit), t, np.int32)), pa.array(codes[:, t]), *(part.column(k) for k in ("node", "space", "vector"))], ["tbl", "code", "node", "space", "vector"])


def top(cosine: np.ndarray, nodes: np.ndarray, k: int):
    """The k best other columns of each row of a square matrix of cosines."""
    n = len(nodes)
    k = min(k, n - 1)
    cosine = cosine.copy()
    np.fill_diagonal(cosine, -2)
    best = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < n - 1 else np.argsort(-cosine, axis=1)[:, :k]
    rows = np.repeat(np.arange(n), k)
    return nodes[rows], nodes[best.ravel()], cosine[rows, best.ravel()]


def bests(parts: list[tuple]) -> pa.RecordBatch:
    a, b, x = (np.concatenate(p) for p in zip(*parts))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(x)], ["node", "other", "cosine"])


def _leaves(k: int):
    """Compare runs of LEAF rows of one table and space in the order of their codes."""

    def run(batches):
        held: list[tuple] = []
        key = None

        def flush():
            if len(held) > 1:
                unit = np.stack([h[1] for h in held])
                yield bests([top(unit @ unit.T, np.array([h[0] for h in held]), k)])

        for batch in batches:
            spaces, tables, ids = batch.column("space").to_pylist(), batch.column("tbl").to_pylist(), batch.column("node").to_pylist()
            keys = [(t, s["label"], s["width"]) for t, s in zip(tables, spaces)]
            at = 0
            while at < len(keys):
                to = at
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                if keys[at] != key:
                    yield from flush()
                    held, key = [], keys[at]
                unit = unit_rows(batch.column("vector").slice(at, to - at), key[2])
                for i, u in enumerate(unit):
                    held.append((ids[at + i], u))
                    if len(held) == LEAF:
                        yield from flush()
                        held = held[LEAF // 2:]  # leaves overlap by half
                at = to
        yield from flush()

    return run


def merge_lists(found: DataFrame, k: int) -> DataFrame:
    """The k best distinct neighbours of each node; the optimizer cuts each task's rows to k before the shuffle."""
    order = Window.partitionBy("node").orderBy(F.desc("cosine"), "other")
    best = found.groupBy("node", "other").agg(F.max("cosine").alias("cosine"))
    return best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def _joins(k: int):
    """Compare what a node gathered; rows come sorted by the gathering node."""

    def run(batches):
        at, held, out, size = None, [], [], 0

        def compare():
            by_width: dict[int, list] = {}
            for h in held:
                by_width.setdefault(len(h[1]), []).append(h)
            for members in by_width.values():
                if len(members) > 1:
                    nodes, first = np.unique(np.array([h[0] for h in members]), return_index=True)
                    if len(nodes) < 2:
                        continue
                    unit = np.stack([members[i][1] for i in first])
                    floor = np.array([members[i][2] for i in first])
                    a, b, x = top(unit @ unit.T, nodes, k)
                    better = x > floor[np.searchsorted(nodes, a)]
                    if better.any():
                        yield a[better], b[better], x[better]

        for batch in batches:
            gather, nodes, floors = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("gather", "node", "floor"))
            lengths = np.diff(np.asarray(batch.column("vector").offsets))
            flat = np.asarray(batch.column("vector").flatten()).astype(np.float64)
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            norm = np.sqrt(np.add.reduceat(flat * flat, bounds[:-1])) if len(lengths) else flat
            flat = flat / np.repeat(norm, lengths)
            for i in range(len(gather)):
                if gather[i] != at:
                    for got in compare():
                        out.append(got)
                        size += len(got[0])
                    at, held = gather[i], []
                held.append((nodes[i], flat[bounds[i]: bounds[i + 1]], floors[i]))
            if size > 100_000:
                yield bests(out)
                out, size = [], 0
        out += compare()
        if out:
            yield bests(out)

    return run


def descend(nodes: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """One round: neighbours of neighbours meet at the node between them."""
    # the node in the middle is gathered, too; of the nodes that point to it about k are drawn by hash
    pointed = lists.groupBy("other").agg(F.count("*").alias("degree"))
    draw = F.pmod(F.xxhash64("node", "other"), F.lit(1 << 20)) * F.col("degree") < F.lit(k << 20)
    back = lists.join(pointed, "other").filter(draw).select(F.col("other").alias("gather"), "node")
    gathered = lists.select(F.col("node").alias("gather"), F.col("other").alias("node")).union(back).union(
        lists.select(F.col("node").alias("gather"), "node")).distinct()
    worst = lists.groupBy("node").agg(F.when(F.count("*") >= k, F.min("cosine")).otherwise(-2.0).alias("floor"))
    known = nodes.select("node", "vector").join(worst, "node", "left").fillna(-2.0, ["floor"])
    met = gathered.join(known, "node").repartition("gather").sortWithinPartitions("gather")
    return c.map_batches(met.select("gather", "node", "floor", "vector"), _joins(k), BESTS)


def _audit(queries):
    """Links of the sampled nodes with all nodes: counts by sampled node."""

    def run(batches):
        spaces, ids, units = queries.value
        count = {i: 0 for i in ids}
        for batch in batches:
            keys = [(s["label"], s["width"]) for s in batch.column("space").to_pylist()]
            for key in set(keys):
                pick = [q for q, s in enumerate(spaces) if s == key]
                if pick:
                    mask = pa.array([x == key for x in keys])
                    part = batch.filter(mask)
                    near = unit_rows(part.column("vector"), key[1]) @ np.stack([units[q] for q in pick]).T >= NEAR
                    own = part.column("node").to_numpy()[:, None] == np.array([ids[q] for q in pick])
                    for q, n in zip(pick, (near & ~own).sum(0).tolist()):
                        count[ids[q]] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int64()), pa.array(list(count.values()), pa.int64())], ["node", "links"])

    return run


def node_recall(audited: list[tuple]) -> float:
    """Mean recall of (true links, found links, piece or None) over nodes with links; the nodes of a piece weigh as one."""
    linked = [a for a in audited if a[0]]
    if not linked:
        return 1.0
    of_piece = Counter(piece for _, _, piece in linked if piece is not None)
    weight = [1 / of_piece[piece] if piece is not None else 1.0 for _, _, piece in linked]
    return sum(w * min(found, true) / true for w, (true, found, _) in zip(weight, linked)) / sum(weight)


def recall(nodes: DataFrame, counts: DataFrame, pieces: DataFrame) -> float:
    """Recall of ``counts`` (node, links) by node; half of the AUDITED nodes are drawn from all, half are one of a piece each.

    The sample is fixed in size, and it is compared with all nodes.
    """
    some = nodes.orderBy(F.xxhash64("node")).limit(AUDITED // 2).select("node")
    of_piece = counts.filter("links > 0").join(pieces, "node", "left").groupBy(F.coalesce("root", "node").alias("piece")).agg(F.min_by("node", F.xxhash64("node")).alias("node"))
    linked = of_piece.orderBy(F.xxhash64("node")).limit(AUDITED // 2).select("node")
    sample = nodes.join(F.broadcast(some.union(linked).distinct()), "node").toArrow()
    if not sample.num_rows:
        return 1.0
    spaces = [(s["label"], s["width"]) for s in sample.column("space").to_pylist()]
    ids = sample.column("node").to_pylist()
    units = [unit_rows(pa.array([v], pa.list_(pa.float64())), len(v))[0] for v in sample.column("vector").to_pylist()]
    queries = nodes.sparkSession.sparkContext.broadcast((spaces, ids, units))
    true = c.map_batches(nodes, _audit(queries), "node long, links long").groupBy("node").agg(F.sum("links").alias("true"))
    got = true.filter(F.col("true") > 0).join(counts, "node", "left").join(pieces, "node", "left").select(
        "true", F.coalesce("links", F.lit(0)).alias("links"), F.when(F.col("links") > 0, F.coalesce("root", "node"))).collect()
    return node_recall([tuple(r) for r in got])


def _blocks(batches):
    """Links of each node within its group (piece, i, j): how many nodes and how many rows they stand for."""
    key, held = None, []

    def compare():
        (_, i, j) = key
        held.sort(key=lambda h: h[0])
        nodes, times = np.array([h[1] for h in held]), np.array([h[3] for h in held])
        unit = np.stack([h[2] for h in held])
        unit /= np.sqrt((unit * unit).sum(1))[:, None]
        cut = len(held) if i == j else sum(h[0] == i for h in held)
        near = (unit[:cut] @ (unit if i == j else unit[cut:]).T) >= NEAR
        if i == j:
            np.fill_diagonal(near, False)
            return nodes, near.sum(1), near @ times
        return nodes, np.concatenate([near.sum(1), near.sum(0)]), np.concatenate([near @ times[cut:], near.T @ times[:cut]])

    out, size = [], 0
    for batch in batches:
        vectors = batch.column("vector")
        bounds, flat = np.asarray(vectors.offsets), np.asarray(vectors.values).astype(np.float64)
        for r, (piece, i, j, block, node, times) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("piece", "i", "j", "block", "node", "times")))):
            if (piece, i, j) != key:
                if len(held) > 1:
                    out.append(compare())
                    size += len(held)
                key, held = (piece, i, j), []
            held.append((block, node, flat[bounds[r]: bounds[r + 1]], times))
        if size > 100_000:
            yield _counts(out)
            out, size = [], 0
    if len(held) > 1:
        out.append(compare())
    if out:
        yield _counts(out)


def _counts(parts):
    a, n, rows = (np.concatenate(p).astype(np.int64) for p in zip(*parts))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(n), pa.array(rows)], ["node", "links", "rows"])


def count_links(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """node, links (nodes), rows (vectors): all links inside each connected piece."""
    members = pieces.select("node", F.col("root").alias("piece")).union(pieces.select("root", "root").distinct())
    size = members.groupBy("piece").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = nodes.join(members, "node").join(size, "piece").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "piece", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "times", "vector")
    dealt = dealt.repartition("piece", "i", "j").sortWithinPartitions("piece", "i", "j")
    return c.map_batches(dealt, _blocks, "node long, links long, rows long").groupBy("node").agg(F.sum("links").alias("links"), F.sum("rows").alias("rows"))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept, recall (of the audit) of every row."""
    rows = c.written(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(VECTOR).alias("embedding"), F.col(label).alias("label"))
                     .withColumn("row", F.monotonically_increasing_id()))
    nodes = c.written(nodes_of(rows))
    largest = nodes.groupBy("space").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    tables = tables_for(largest)
    space = "space struct<label:" + rows.schema["label"].dataType.simpleString() + ",width:int>"

    def start(tables: int, salt: int, k: int) -> DataFrame:
        coded = c.map_batches(nodes.select("node", "space", "vector"), _codes(tables, salt), f"tbl int, code long, node long, {space}, vector array<double>")
        ordered = coded.repartitionByRange("tbl", "space", "code", "node").sortWithinPartitions("tbl", "space", "code", "node")
        return c.map_batches(ordered, _leaves(k), BESTS)

    k = LIST
    lists = c.written(merge_lists(start(tables, 0, k), k))
    for round_ in range(ROUNDS):
        lists = c.written(merge_lists(descend(nodes, lists, k).union(lists), k))
        edges = lists.filter(F.col("cosine") >= NEAR)
        pieces = c.written(graphs.components(edges.select(F.col("node").alias("a"), F.col("other").alias("b"))))
        counts = c.written(count_links(nodes, pieces))
        audit = recall(nodes, counts.select("node", "links"), pieces)
        if audit >= RECALL and round_:
            break
        if round_ and round_ + 1 < ROUNDS:
            k = min(2 * k, max(k, LEAF))
            lists = c.written(merge_lists(start(tables * (round_ + 1), round_, k).union(lists), k))
    else:
        raise RuntimeError(f"the audited recall is {audit:.4f} after {ROUNDS} rounds, below {RECALL}")
    twins = rows.filter(F.col("label").isNotNull() & usable(F.col("embedding"))).select("row", "vec_id", "label", "embedding")
    named = twins.join(nodes.select("node", "times", F.col("space.label").alias("label"), F.col("vector").alias("embedding")), ["label", "embedding"])
    named = named.join(pieces, "node", "left").join(counts, "node", "left").select(
        "row", "vec_id", F.coalesce("root", "node").alias("root"), (F.col("times") - 1 + F.coalesce("rows", F.lit(0))).alias("n_links"))
    first = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    good = named.join(first, "root").select("vec_id", "n_links", "component_id")
    bad = rows.filter(F.col("label").isNull() | ~usable(F.col("embedding"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))).withColumn("recall", F.lit(float(audit)))
