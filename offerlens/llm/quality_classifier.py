"""Quality classifier: naive Bayes support vectors.

Features are n-gram indicators: byte pairs and triples of the whole text, and runs of one to three word shapes (letter
case, last character, symbols, and whether the word repeats the one before), hashed into ``FEATURES``. An
indicator is scaled by its class log-count ratio, rows are scaled to unit length, and a linear model with hinge
loss is fitted by dual coordinate descent; its weights are drawn towards their mean size as naive Bayes
support vectors do. A logistic curve through held-back rows of the sample makes margins into scores.

The model comes from a bounded sample of labelled rows (``per_class`` of each class) and is broadcast: two
numbers per feature. A null or empty text has no features and scores the intercept; repeated rows score
alike; without labels of both classes every score is the share of label 1 (0 without labels). Only doc_id
and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.llm import common as c
from offerlens.llm import sampling

BITS = 18
FEATURES = 1 << BITS
GOOD_AT = 0.5
SYMBOL = np.isin(np.arange(256), list(b"#$%&*+-/<=>@[\\]^_`{|}~"))
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
SMALL = np.zeros(256, bool)
SMALL[97:123] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
#: Class of a word's last byte: letter or other, stop, comma, exclamation mark, symbol, digit.
LAST = np.zeros(256, np.int64)
LAST[list(b".;:?")], LAST[list(b",")], LAST[list(b"!")] = 1, 2, 3
LAST[SYMBOL], LAST[DIGIT] = 4, 5


def shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and shape code of each word."""
    start, end, row = c.word_spans(data, offsets)
    counts = [np.concatenate([[0], np.cumsum(table[data])]) for table in (UPPER, SMALL, SYMBOL)]
    upper, small, symbol = (x[end] - x[start] for x in counts)
    hashes = c.span_hash(c.prefix_hash(data, c.LOWER), start, end)
    same = np.zeros(len(start), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    case = np.where(upper > 1, 2 + (small == 0), (upper > 0).astype(int))
    marks = np.where(symbol == 0, 0, np.where(symbol == end - start, 2, 1))
    return row, ((case * 3 + marks) * 6 + LAST[data[end - 1]]) * 2 + same


def _hash(keys: np.ndarray, salt: int) -> np.ndarray:
    return (((keys.astype(np.uint64) + np.uint64(salt)) * c.STEP[4]) >> np.uint64(64 - BITS)).astype(np.int64)


class Indicators:
    """Distinct features of each row of a slice."""

    def __init__(self):
        self.seen = np.zeros(FEATURES, np.int64)

    def rows(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        wide = data.astype(np.uint64)
        pair = wide[:-1] * np.uint64(256) + wide[1:] if n > 1 else np.zeros(0, np.uint64)
        triple = pair[:-1] * np.uint64(256) + wide[2:] if n > 2 else np.zeros(0, np.uint64)
        pair, triple = _hash(pair, 1 << 40), _hash(triple, 2 << 40)
        row, shape = shapes(data, offsets)
        runs = [(_hash(shape, 3 << 40), row)]
        for k in (1, 2):
            code = sum(shape[j: len(shape) - k + j] * 512 ** j for j in range(k + 1)) if len(shape) > k else shape[:0]
            runs.append((_hash(code, (3 + k) << 40), row[: len(code)]))
        bounds = [np.searchsorted(r, np.arange(len(offsets))) for _, r in runs]
        for i in range(len(offsets) - 1):
            a, b = int(offsets[i]), int(offsets[i + 1])
            parts = [pair[a: max(a, b - 1)], triple[a: max(a, b - 2)]]
            for k, (f, _) in enumerate(runs):
                lo, hi = int(bounds[k][i]), int(bounds[k][i + 1])
                # a run must not reach into the next row
                parts.append(f[lo: max(lo, min(hi, int(bounds[0][i + 1]) - k))])
            f = np.concatenate(parts)
            place = np.arange(len(f))
            self.seen[f] = place
            yield f[self.seen[f] == place]


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = [np.full(FEATURES, alpha), np.full(FEATURES, alpha)]
    for f, label in zip(rows, y):
        counts[label][f] += 1
    used = (counts[0] + counts[1]) > 2 * alpha
    good, bad = (x / x[used].sum() for x in (counts[1], counts[0]))
    return np.where(used, np.log(good / bad), 0.0)


def dual_descent(rows, values, y, cost: float = 1.0, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Linear model with hinge loss; the last weight is the intercept's."""
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(FEATURES + 1), np.zeros(len(rows))
    sign = np.where(y == 1, 1.0, -1.0)
    upper = np.where(y == 1, cost * 0.5 / y.mean(), cost * 0.5 / (1 - y.mean()))
    norm = np.array([v @ v + 1 for v in values])
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), upper[i])
            if new != alpha[i]:
                change = (new - alpha[i]) * sign[i]
                w[rows[i]] += change * values[i]
                w[-1] += change
                alpha[i] = new
    return w


def interpolated(w: np.ndarray, beta: float) -> np.ndarray:
    """Weights of ratio-scaled features, drawn towards their mean size: naive Bayes alone gives all features one weight."""
    used = w[w != 0]
    return (1 - beta) * (np.abs(used).mean() if len(used) else 0.0) + beta * w


def train(texts: list[str], labels: list[int], beta: float = 0.5):
    """weight per feature (ratio times model), ratio per feature, intercept, slope, offset."""
    y = np.array(labels, int)
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
        return np.zeros(FEATURES, np.float32), np.zeros(FEATURES, np.float32), 0.0, 1.0, float(np.log(p / (1 - p)))
    indicators, rows = Indicators(), []
    for _, data, offsets in c.text_slices(pa.array(texts, pa.large_string())):
        rows += indicators.rows(data, offsets)
    held = np.arange(len(y)) % 5 == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    fit = np.flatnonzero(~held)
    ratio = log_count_ratios([rows[i] for i in fit], y[fit])
    scaled = [_unit(ratio[f]) for f in rows]
    w = dual_descent([rows[i] for i in fit], [scaled[i] for i in fit], y[fit])
    bias, w = w[-1], w[:-1]
    w = interpolated(w, beta)
    margin = np.array([w[f] @ v + bias for f, v in zip(rows, scaled)])
    check = held if held.any() else ~held
    slope, offset = sampling.calibrate(margin[check], y[check])
    return (w * ratio).astype(np.float32), ratio.astype(np.float32), float(bias), slope, offset


def _unit(v: np.ndarray) -> np.ndarray:
    size = np.sqrt(v @ v)
    return v / size if size > 0 else v


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 3000, longest: int = 50_000) -> DataFrame:
    """All columns of ``docs``, and ``score`` (replacing a column of that name)."""
    model = docs.sparkSession.sparkContext.broadcast(train(*sampling.labelled(docs, labels, label, per_class, longest)))

    def run(batches):
        weight, ratio, bias, slope, offset = model.value
        square, indicators = ratio * ratio, Indicators()
        for batch in batches:
            margins = []
            for _, data, offsets in c.text_slices(batch.column("text")):
                for f in indicators.rows(data, offsets):
                    size = square[f].sum(dtype=np.float64)
                    margins.append(bias + (weight[f].sum(dtype=np.float64) / np.sqrt(size) if size > 0 else 0.0))
            z = np.clip(slope * np.array(margins, np.float64) + offset, -40, 40)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-z)))], [*batch.schema.names, "score"])

    docs = docs.drop("score")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score_documents(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), labels)
    return scored.select("doc_id", sampling.held_out().alias("held_out"), "score", (F.col("score") >= GOOD_AT).cast("int").alias("predicted"))
