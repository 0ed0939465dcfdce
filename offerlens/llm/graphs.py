"""Connected components of a link table by alternating star steps.

Each task first contracts the links it happens to hold. A round then sends every node's links to the
smallest neighbour (from one aggregate per node), follows one step from that neighbour to its own smallest, and
stops when no node has two neighbours and no neighbour is a node itself. Rounds grow with the logarithm of the
longest path. Every round is an aggregate with map-side combining and two many-to-one joins, so a node with a third of all
links is split by the skew join; each round's table is written to the shared folder.

Null ends and links of a node to itself are left out; links may repeat and may point either way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for all nodes but the smallest, of the links a-b."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        for side in (left, right):
            np.minimum.at(new, label[side], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _contract(batches):
    a, b, held = [], [], 0
    for batch in batches:
        a.append(batch.column("a").to_numpy())
        b.append(batch.column("b").to_numpy())
        held += batch.num_rows
        if held > 2_000_000:
            node, root = contract(np.concatenate(a), np.concatenate(b))
            a, b, held = [node], [root], len(node)
            if held > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])
                a, b, held = [], [], 0
    if held:
        node, root = contract(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links reach, for every node but the smallest ones themselves.

    ``links`` has long columns a and b.
    """
    clean = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    stars = c.written(c.map_batches(clean, _contract, "node long, root long"))
    while True:
        smallest = stars.groupBy("node").agg(F.min("root").alias("m"), F.max("root").alias("most"))
        moves = smallest.select(F.col("node").alias("root"), F.col("m").alias("further"))
        open_ = stars.join(moves, "root", "left_semi").limit(1).count() + smallest.filter("m < most").limit(1).count()
        if not open_:
            return stars.distinct()
        joined = stars.join(smallest.select("node", "m"), "node")
        own = joined.select("node", F.col("m").alias("root")).distinct()
        # a node's other neighbours belong to its smallest one
        others = joined.filter("root <> m").select(F.col("root").alias("node"), F.col("m").alias("root"))
        jumped = own.join(moves, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
        stars = c.written(jumped.union(others).distinct())
