"""A bounded sample of labelled documents for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c

FOLDS, HELD_OUT = 3, 1


def held_out(column: str = "doc_id"):
    return F.coalesce(c.crc_mod(column, FOLDS) == HELD_OUT, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int) -> tuple[list[str], list[int]]:
    """Whole texts and labels of at most ``per_class`` training rows of each class.

    Rows of the held-out fold are never read. The choice is by a hash of the id, so it does not depend on
    the order of rows. Texts of more than ``longest`` characters are left out of the sample (they are
    scored like all others). An id with several labels has the largest; its label and
    text may be null, then it is not used.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    fit = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(
        F.col("text").isNotNull() & (F.length("text") <= longest))
    texts, ys = [], []
    for y in (0, 1):
        # chosen by id first, with some spare for ids whose text does not qualify
        ids = known.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id")).limit(2 * per_class)
        rows = fit.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(per_class).select("text").toArrow()
        texts += rows.column("text").to_pylist()
        ys += [y] * rows.num_rows
    del rows
    c.release(docs.sparkSession)  # the driver trains next
    return texts, ys


def calibrate(logits: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve through validation logits (Platt's targets, Newton steps)."""
    positive = y.sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    x = np.stack([logits, np.ones(len(y))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        gradient = x.T @ (p - target) + 1e-2 * (theta - [1, 0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        theta -= step / max(1.0, np.abs(step).max() / 2)
    return float(max(theta[0], 1e-3)), float(theta[1])
