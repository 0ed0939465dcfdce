"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 6 bytes of UTF-8, with marks for its ends), hashed into
``BUCKETS`` embeddings. A passage is ``PASSAGE`` words in a row of a text, each different word counted once; it is
the mean of its n-grams' embeddings, padded with zeros to ``LEAST_GRAMS`` n-grams, and a linear softmax turns that mean into class probabilities. Embeddings and softmax are trained together. Misspelt or unseen
words share most n-grams with words from training and so their vectors.

A document has as many passages as its length asks for (each half over the next); its score is that of its most
toxic passage, so a few words in a very long text do not drown in the mean. Training draws a random passage of each
document first and later the passage that scores highest, with the document's label. Embeddings start near zero and
take plain gradient steps, so an n-gram weighs as much as texts speak for it; those of fewer than ``LEAST_TEXTS``
texts stay at zero. Every fifth text calibrates a model of the others; the model that scores is of all of them, its
scale by that calibration, for classes whose ratio is the square root of the sample's.

The model comes from a bounded sample of labelled rows (``per_class`` of each class); since the softmax
is linear in the mean, what scoring needs is one number per bucket, which is broadcast. A null or empty text
has an empty bag and scores the bias alone; repeated rows score alike; without labels of both classes every
score is the share of label 1 (0 without labels). Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.llm import common as c
from offerlens.llm import sampling

BUCKETS = 1 << 17
GRAMS = (3, 4, 5, 6)
DIM = 4
PASSAGE, STRIDE, LEAST_GRAMS = 48, 24, 500
TOXIC_AT = 0.7
BATCH = 128
LEAST_TEXTS = 3
SLICE = 1 << 18


def subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of each n-gram of ``<word>``, in order of words."""
    size = end - start + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    text = np.full(begin[-1], ord("<"), np.uint8)
    word = np.repeat(np.arange(len(start)), size)
    inner = np.ones(begin[-1], bool)
    inner[begin[:-1]] = inner[begin[1:] - 1] = False
    text[inner] = data[np.repeat(start - begin[:-1] - 1, size - 2) + np.flatnonzero(inner)]
    text[begin[1:] - 1] = ord(">")
    sums = c.prefix_hash(text, c.LOWER)
    words, buckets = [], []
    for n in GRAMS:
        if len(text) < n:
            continue
        at = np.flatnonzero(word[: len(text) - n + 1] == word[n - 1:])
        words.append(word[at])
        buckets.append((c.span_hash(sums, at, at + n) & np.uint64(BUCKETS - 1)).astype(np.int64))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words, buckets = np.concatenate(words), np.concatenate(buckets)
    order = np.argsort(words, kind="stable")
    return words[order], buckets[order]


def numbered_words(data: np.ndarray, offsets: np.ndarray):
    """Row and number of every word in order, and the spans of the numbered words."""
    start, end, row = c.word_spans(data, offsets)
    hashes = c.span_hash(c.prefix_hash(data, c.LOWER), start, end)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    return row, number, start[first], end[first]


def earlier(row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Place of the same word before each word in its row, -1 for the first."""
    order = np.lexsort((number, row))
    out = np.full(len(row), -1, np.int32)
    same = (number[order[1:]] == number[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    out[order[1:][same]] = order[:-1][same]
    return out


def bags(before: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different words of each passage, and the passage of each place."""
    size = stop - first
    at, owner = spread_out(first, size), np.repeat(np.arange(len(first)), size)
    fresh = before[at] < first[owner]
    return at[fresh], owner[fresh]


def passages(row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and row of each passage; ``row`` is sorted, an empty row has none."""
    count = np.bincount(row, minlength=n)
    begin = np.concatenate([[0], np.cumsum(count)])
    parts = np.where(count > 0, np.maximum(1, -(-(count - STRIDE) // STRIDE)), 0)
    at = np.repeat(np.arange(n), parts)
    k = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = begin[at] + k * STRIDE
    return first, np.minimum(first + PASSAGE, begin[at + 1]), at


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Indexed:
    """Training texts as numbers: passages of words, words of buckets; built slice by slice."""

    def __init__(self, texts: list[str]):
        numbers: dict[int, int] = {}
        rows, words, grams, sizes, at = [], [], [], [], 0
        for _, data, offsets in c.text_slices(pa.array(texts, pa.large_string()), SLICE):
            row, number, start, end = numbered_words(data, offsets)
            hashes = c.span_hash(c.prefix_hash(data, c.LOWER), start, end).tolist()
            fresh = np.array([h not in numbers for h in hashes], bool)
            numbers.update(dict(zip([h for h, new in zip(hashes, fresh) if new], range(len(numbers), len(numbers) + len(hashes)))))
            if fresh.any():
                word, bucket = subwords(data, start[fresh], end[fresh])
                grams.append(bucket.astype(np.int32))
                sizes.append(np.bincount(word, minlength=int(fresh.sum())))
            rows.append((row + at).astype(np.int32))
            words.append(np.array([numbers[h] for h in hashes], np.int32)[number])
            at += len(offsets) - 1
        none = np.zeros(0, np.int64)
        row, self.word = np.concatenate([none.astype(np.int32), *rows]), np.concatenate([none.astype(np.int32), *words])
        self.before = earlier(row, self.word)
        self.gram = np.concatenate([none.astype(np.int32), *grams])
        self.at = np.concatenate([[0], np.cumsum(np.concatenate([none, *sizes]))])
        self.first, self.stop, self.owner = passages(row, len(texts))
        self.texts = len(texts)

    def texts_of_buckets(self) -> np.ndarray:
        """How many texts hold each bucket."""
        count = np.zeros(BUCKETS, np.int64)
        size = np.zeros(self.texts, np.int64)
        np.maximum.at(size, self.owner, self.stop)
        begin = np.full(self.texts, len(self.word))
        np.minimum.at(begin, self.owner, self.first)
        for first, stop in zip(begin, size):
            if first < stop:
                word = np.unique(self.word[first:stop])
                count[np.unique(self.gram[spread_out(self.at[word], self.at[word + 1] - self.at[word])])] += 1
        return count

    def logits(self, z: np.ndarray) -> np.ndarray:
        """Mean weight of the n-grams of each passage."""
        if not len(self.word):
            return np.zeros(0)
        total, grams = np.add.reduceat(z.astype(np.float32)[self.gram], self.at[:-1]), np.diff(self.at)
        return passage_means(total, grams, self.word, self.before, self.first, self.stop)


def train(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """One weight per bucket and the bias; the scale is calibrated on every fifth row by a fit that does not see them."""
    every = np.array(labels)
    z, bias = fit_weights(Indexed(texts), every)
    y = every[::5]
    if len(y) < 20 or y.min() == y.max() or not z.any():
        return z, bias
    fit = [k for k in range(len(texts)) if k % 5]
    part, part_bias = fit_weights(Indexed([texts[k] for k in fit]), every[fit])
    rest = Indexed(texts[::5])
    best = np.full(len(y), -np.inf)
    np.maximum.at(best, rest.owner, rest.logits(part))
    slope, offset = sampling.calibrate(np.where(np.isinf(best), 0, best) + part_bias, y)
    offset += 0.5 * np.log((1 - every.mean()) / every.mean())
    return (z * slope).astype(np.float32), float(bias * slope + offset)


def spread_out(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``size`` numbers of each."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def fit_weights(data: Indexed, labels: np.ndarray, updates: int = 600, rate: float = 40.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """Embeddings times the difference of the two softmax rows, and the difference of their biases."""
    y = labels.astype(np.float64)
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
        return np.zeros(BUCKETS, np.float32), float(np.log(p / (1 - p)))
    rng = np.random.default_rng(seed)
    share = np.bincount(data.owner, minlength=data.texts)
    rows = np.flatnonzero(share)
    lead = np.concatenate([[0], np.cumsum(share)])
    emb = rng.normal(0, 1e-6, (BUCKETS, DIM))
    keep = data.texts_of_buckets() >= LEAST_TEXTS
    emb[~keep] = 0
    soft, bias = rng.normal(0, 0.3, (DIM, 2)), np.zeros(2)
    speed_e, speed_s, speed_b = np.zeros_like(emb), np.zeros_like(soft), np.zeros(2)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    epochs = max(20, -(-updates * BATCH // max(1, len(rows))))
    for epoch in range(epochs):
        if epoch < epochs // 4:
            pick = lead[rows] + rng.integers(0, share[rows])
        else:
            order = np.lexsort((data.logits(emb @ (soft[:, 1] - soft[:, 0])), data.owner))
            pick = order[lead[rows + 1] - 1]  # the passage with the highest score of each document
        step = rate * (1 - 0.9 * epoch / epochs)
        shuffled = rng.permutation(len(rows))
        for k in range(0, len(rows), BATCH):
            batch = shuffled[k: k + BATCH]
            chosen = pick[batch]
            place, bag = bags(data.before, data.first[chosen], data.stop[chosen])
            token = data.word[place]
            grams = data.at[token + 1] - data.at[token]
            gram = data.gram[spread_out(data.at[token], grams)]
            bag = np.repeat(bag, grams)
            size = np.maximum(LEAST_GRAMS, np.bincount(bag, minlength=len(batch)))
            mean = np.stack([np.bincount(bag, emb[gram, d], len(batch)) for d in range(DIM)], 1) / size[:, None]
            score = mean @ soft + bias
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), y[rows[batch]].astype(int)] -= 1
            p *= weight[rows[batch]][:, None] / len(batch)
            to_mean = p @ soft.T / size[:, None]
            known = keep[gram]
            gram, bag = gram[known], bag[known]
            used, inverse = np.unique(gram, return_inverse=True)
            grad = np.stack([np.bincount(inverse, to_mean[bag, d], len(used)) for d in range(DIM)], 1) + 1e-6 * emb[used]
            speed_e[used] += grad ** 2
            emb[used] -= step * grad / (np.sqrt(speed_e[used]) + 4e-3)
            for value, speed, g in ((soft, speed_s, mean.T @ p), (bias, speed_b, p.sum(0))):
                speed += g ** 2
                value -= 0.2 * step * g / (np.sqrt(speed) + 1e-6)
    return (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def passage_means(total, grams, number, before, first, stop, some: int = 1 << 14):
    """Mean weight of the n-grams of each passage's different words; ``total`` and ``grams`` are sums by word."""
    out = np.zeros(len(first))
    for k in range(0, len(first), some):
        n = len(first[k: k + some])
        place, owner = bags(before, first[k: k + some], stop[k: k + some])
        word = number[place]
        out[k: k + n] = np.bincount(owner, total[word], n) / np.maximum(LEAST_GRAMS, np.bincount(owner, grams[word], n))
    return out


def best_logits(z: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The largest passage mean of each row; 0 for a row without words."""
    n = len(offsets) - 1
    best = np.full(n, -np.inf)
    row, number, start, end = numbered_words(data, offsets)
    if len(row):
        word, bucket = subwords(data, start, end)
        total, grams = np.bincount(word, z[bucket], len(start)), np.bincount(word, minlength=len(start))
        first, stop, owner = passages(row, n)
        np.maximum.at(best, owner, passage_means(total, grams, number, earlier(row, number), first, stop))
    best[np.isinf(best)] = 0.0
    return best


def _scored(model, name: str):
    """Rows with their scores, slice by slice: what a worker holds besides its batch does not grow with the batch."""

    def run(batches):
        z, bias = model.value
        for batch in batches:
            for first, data, offsets in c.text_slices(batch.column("text"), SLICE):
                part = batch.slice(first, len(offsets) - 1)
                scores = sigmoid(best_logits(z, data, offsets) + bias)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*part.schema.names, name])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 2000, longest: int = 50_000, name: str = "score") -> DataFrame:
    """All columns of ``docs``, and the score as ``name`` (replacing a column of that name)."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(*sampling.labelled(docs, labels, label, per_class, longest)))
    docs = docs.drop(name)
    return c.map_batches(docs, _scored(model, name), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score_documents(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), labels)
    return scored.select("doc_id", sampling.held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with all their columns, a ``score`` of their own included."""
    scored = score_documents(docs.withColumn("text", F.col("text").cast("string")), labels, name="__toxicity")
    return scored.filter(F.col("__toxicity") < TOXIC_AT).select(*docs.columns)
