"""Ordered folds over shared keys, without an ordered loop over all rows.

An item is decided by earlier items only, and only by those that it is connected with through shared keys. So the
connected components are folded side by side, each as one ordered stream of rows through a task. A component of more than
``LIMIT`` rows is folded from its beginning up to about so many, which does not depend on what follows; what this rules out goes,
and the rest starts again, in components of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.session import materialized

LIMIT = 500_000


def _contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links a-b with the smallest node that they lead to."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a):]
    low = np.arange(len(names))
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if np.array_equal(new, low):
            return names, names[low]
        low = new


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b, rows = [], [], 0

    def stars():
        node, root = _contract(np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])

    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        rows += batch.num_rows
        if rows > 1_000_000:
            yield stars()
            a, b, rows = [], [], 0
    if rows:
        yield stars()


def components(links: DataFrame) -> DataFrame:
    """node, root: every node of the links (two long columns) with the smallest node of its connected component.

    Tasks contract the links they hold. In each round a node's roots are joined to the smallest of them, and that is replaced
    by its own root: aggregates with map-side combining and many-to-one joins, in a number of rounds that grows with the logarithm of the longest path.
    """
    stars = materialized(links.mapInArrow(_local_stars, "node long, root long"))
    while True:
        best = stars.groupBy("node").agg(F.min("root").alias("best"), F.max("root").alias("worst"))
        further = best.select(F.col("node").alias("best"), F.least("best", "node").alias("next"))
        joined = stars.join(best.select("node", "best"), "node")
        own = joined.select("node", "best").distinct().join(further, "best", "left").select("node", F.coalesce("next", "best").alias("root"), F.lit(True).alias("own"))
        others = joined.filter("root <> best").select(F.col("root").alias("node"), F.col("best").alias("root"), F.lit(False).alias("own"))
        turned = materialized(own.union(others).distinct())
        after = turned.select("node", "root").distinct()
        settled = turned.filter("NOT own").isEmpty() and after.join(after.filter("node <> root").select(F.col("node").alias("root")), "root", "left_semi").isEmpty()
        if settled:
            return after
        stars = after


def _part(rows: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """``rows`` (root, item, ...) with ``cut``, the last item of each component that is folded now, and whether any has more."""
    sizes = rows.groupBy("root").agg(F.count(F.lit(1)).alias("rows"))
    large = materialized(sizes.filter(F.col("rows") > limit))
    if large.isEmpty():
        return rows.withColumn("cut", F.lit(None).cast("long")), False
    cuts = rows.join(large, "root").groupBy("root", "rows").agg(F.percentile_approx("item", F.array(*[F.lit(k / 1000) for k in range(1, 1000)])).alias("items"))
    place = F.greatest(F.lit(1), F.least(F.lit(999), F.floor(F.lit(1000 * limit) / F.col("rows")))).cast("int")
    return rows.join(cuts.select("root", F.element_at("items", place).alias("cut")), "root", "left"), True


def _streams(rows: DataFrame, fold, schema: str) -> DataFrame:
    """Each component's rows in order through one call of ``fold`` per item."""
    return rows.repartition("root").sortWithinPartitions("root", "item").mapInArrow(fold, schema)


def _fold_claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root = item = None
    taken: set[str] = set()
    asked: list[str] = []
    held: list[str] = []
    kept: list[int] = []

    def decide():
        if item is not None and not any(k in taken for k in asked):
            kept.append(item)
            taken.update(held)

    for batch in batches:
        for r, i, key, holds, asks in zip(*(batch.column(k).to_pylist() for k in ("root", "item", "key", "holds", "asks"))):
            if (r, i) != (root, item):
                decide()
                if r != root:
                    taken = set()
                root, item, asked, held = r, i, [], []
            if asks:
                asked.append(key)
            if holds:
                held.append(key)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], ["item"])
        kept = []
    decide()
    yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], ["item"])


def first_kept(claims: DataFrame, limit: int = LIMIT) -> DataFrame:
    """item: those that an ordered read keeps. An item is kept unless an earlier kept item holds a key that it asks for.

    ``claims``: item (long, in order), key (string), holds, asks.
    """
    rest, kept = materialized(claims.select("item", "key", "holds", "asks").distinct()), []
    while True:
        shared = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
        open_ = materialized(rest.join(shared, "key"))
        kept.append(rest.select("item").join(open_.select("item"), "item", "left_anti").distinct())
        node = F.xxhash64(F.lit("item"), "item")
        linked = components(open_.select(node.alias("a"), F.xxhash64(F.lit("key"), "key").alias("b")))
        placed, more = _part(open_.withColumn("node", node).join(linked, "node").drop("node"), limit)
        now = placed.filter("cut IS NULL OR item <= cut") if more else placed
        won = materialized(_streams(now, _fold_claims, "item long"))
        kept.append(won)
        if not more:
            break
        later = materialized(placed.filter("item > cut").select("item", "key", "holds", "asks"))
        held = open_.filter("holds").join(won, "item", "left_semi").select("key").distinct()
        gone = later.filter("asks").join(held, "key", "left_semi").select("item").distinct()
        rest = materialized(later.join(gone, "item", "left_anti"))
        if rest.isEmpty():
            break
    out = kept[0]
    for part in kept[1:]:
        out = out.union(part)
    return out


def _fold_choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("root", "item", "option", "base_at", "base", "value")
    root = item = value = None
    last: dict[int, tuple[int, str]] = {}
    options: list[tuple] = []
    out: list[tuple[int, int]] = []

    def decide():
        if item is None:
            return
        best = None
        for option, at, base in options:
            mark = last.get(option)
            now = mark[1] if mark is not None and (at is None or mark[0] > at) else base
            rank = (now is not None, now or "", -option)
            if best is None or rank > best[0]:
                best = rank, option
        out.append((item, best[1]))
        if value is not None:
            last[best[1]] = item, value

    for batch in batches:
        for r, i, option, at, base, v in zip(*(batch.column(k).to_pylist() for k in names)):
            if (r, i) != (root, item):
                decide()
                if r != root:
                    last.clear()
                root, item, value, options = r, i, v, []
            options.append((option, at, base))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], ["item", "option"])
        out = []
    decide()
    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], ["item", "option"])


BLOCK = 1 << 16


def _last_before(asks: DataFrame, events: DataFrame) -> DataFrame:
    """``asks`` (item, option, ...) with base_at and base, the place and value of their option's last event before them.

    Options are cut into blocks of items, so a frequent one is spread over tasks; only a block's last event goes to the blocks behind.
    """
    block = F.floor(F.col("item") / BLOCK)
    marks = events.filter("value IS NOT NULL").select("option", "item", "value", block.alias("block"), F.lit(0).alias("ask"))
    lasts = marks.groupBy("option", "block").agg(F.max(F.struct("item", "value")).alias("mark"))
    places = lasts.select("option", "block", "mark").unionByName(
        asks.select("option", block.alias("block"), F.lit(None).cast("struct<item:long,value:string>").alias("mark"))).groupBy("option", "block").agg(F.max("mark").alias("mark"))
    earlier = places.selectExpr("option", "block", "max(mark) OVER (PARTITION BY option ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier")
    both = marks.unionByName(asks.withColumns({"block": block, "ask": F.lit(1), "value": F.col("value")}), allowMissingColumns=True)
    inside = both.withColumn("inside", F.expr(
        "max(IF(ask = 0, struct(item, value), NULL)) OVER (PARTITION BY option, block ORDER BY item, ask DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    found = inside.filter("ask = 1").join(earlier, ["option", "block"], "left").withColumn("mark", F.coalesce("inside", "earlier"))
    return found.select(*asks.columns, F.col("mark.item").alias("base_at"), F.col("mark.value").alias("mark_value"))


def ordered_choices(asks: DataFrame, events: DataFrame, limit: int = LIMIT) -> DataFrame:
    """item, option: what each item chooses, in order, among its options: the one with the latest value, then the smallest.

    ``asks``: item, option (longs), start (the option's value before all, string), value (which the chosen option takes over, unless null).
    ``events``: item, option, value: choices that are settled already. A missing value ranks last.
    """
    rest, done = materialized(asks.select("item", "option", "start", "value")), []
    events = events.select("item", "option", "value")
    linked = components(rest.select(F.xxhash64(F.lit("item"), "item").alias("a"), F.xxhash64(F.lit("option"), "option").alias("b")))
    node = F.xxhash64(F.lit("item"), "item")
    rest = materialized(rest.withColumn("node", node).join(linked, "node").drop("node"))
    while True:
        based = _last_before(rest, events).withColumn("base", F.coalesce("mark_value", "start"))
        placed, more = _part(based, limit)
        now = placed.filter("cut IS NULL OR item <= cut") if more else placed
        chosen = materialized(_streams(now, _fold_choices, "item long, option long"))
        done.append(chosen)
        if not more:
            break
        values = rest.select("item", "value").distinct()
        events = materialized(events.unionByName(chosen.join(values, "item").select("item", "option", "value")))
        rest = materialized(placed.filter("item > cut").select("item", "option", "start", "value", "root"))
        if rest.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out
