"""LM scoring: prediction by partial matching, trained on the corpus, next to a smoothed unigram base.

Training counts every word and every byte n-gram of the training texts and keeps them all. N-grams are counted in numpy per
task and sent as sorted runs to shards that are dealt by a hash of the ``ppm.NEAR`` nearest context bytes; their number grows with
the input. Shards are scored in groups of about ``GRAMS`` distinct n-grams, as those grow more slowly than the texts: a document gets a
partial score from each group at most. A group's texts are dealt to as many tasks as its shards need, each with the group's n-grams. A group is a trie of its own above the orders that all groups need, which are broadcast. The code lengths of the
n-grams that make up at least one in ``SHARED`` of the training bytes, so at most ``SHARED`` of them, are broadcast, too; all other places
of the texts, known or not, are sent to the shard of their context and scored there. Words are counted by an ordinary
aggregate. The words that make up at least one in ``FREQUENT`` of all tokens, so at most ``FREQUENT`` of them, are broadcast;
the others meet their counts in a join on the word, spread over as many keys as there are rare words.

The training rows are those whose crc32(doc_id as text) mod 10 is not 0 (a null id: training). A null or empty
text is just the end token. Repeated rows count and score as often as they stand there. An empty table gives an
empty result; a table without training rows leaves 256 equally likely bytes and c = N = V = 0. Only
doc_id and text are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c
from offerlens.llm import ppm

FOLDS, HELD_OUT = 10, 0
FREQUENT = 1 << 17
SHARED = 1 << 21
SHARDS, SHARD_BYTES = 16, 16 << 20
GRAMS = 1 << 19
LOW_PARTS = 16
SOME = 3_000_000
MISSES = 500_000
HELD_WORDS = 400_000
SLICE = 1 << 18
GATHERED = "word binary, n long, shard int, keys binary, counts binary"
WIDTH = ppm.ORDER + 1


def held_out(column: str = "doc_id"):
    return F.coalesce(c.crc_mod(column, FOLDS) == HELD_OUT, F.lit(False))


def vocabulary(data, start, end):
    """Number of each word and the lower-cased bytes of the distinct ones."""
    _, first, number = np.unique(c.span_hash(c.prefix_hash(data, c.LOWER), start, end), return_index=True, return_inverse=True)
    raw = c.LOWER[data].tobytes()
    return number, [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]


def shards_of(texts: DataFrame) -> int:
    """As many shards as keep one shard's n-grams about as many at any size of the input."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(SHARDS, -(-size // SHARD_BYTES))


def groups_of(tries: DataFrame, shards: int) -> int:
    """As many groups of shards as keep one group's distinct n-grams about as many at any size of the input."""
    distinct = tries.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()[0] // WIDTH
    return min(shards, max(SHARDS, -(-distinct // GRAMS)))


def _gather(shards: int):
    """Word counts, and runs of n-grams by shard, of a task's texts; runs of order NEAR - 1 have negative shards."""

    def run(batches):
        yield from _gathered(batches, shards)

    return run


def _gathered(batches, shards: int):
    forget()
    words, keys, counts, held = Counter(), [], [], 0

    def word_rows():
        n = len(words)
        out = pa.RecordBatch.from_arrays(
            [pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
            ["word", "n", "shard", "keys", "counts"])
        words.clear()
        return out

    def gram_rows():
        key, count = ppm.merged(keys, counts)
        low, n_low = ppm.shorter(key, count, ppm.NEAR - 1)
        out = [runs_by(shard_of(key, shards), shards, key, count), runs_by((c.mix(low) % np.uint64(LOW_PARTS)).astype(np.int64), LOW_PARTS, low, n_low)]
        shard = [*(x[0] for x in out[0]), *(-1 - x[0] for x in out[1])]
        rows = out[0] + out[1]
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(rows), pa.binary()), pa.array([x[1] for x in rows], pa.int64()), pa.array(shard, pa.int32()),
             pa.array([x[2] for x in rows], pa.binary()), pa.array([x[3] for x in rows], pa.binary())],
            ["word", "n", "shard", "keys", "counts"])

    for batch in batches:
        for _, data, offsets in c.text_slices(batch.column("text")):
            n = len(offsets) - 1
            start, end, row = c.word_spans(data, offsets)
            number, distinct = vocabulary(data, start, end)
            words.update(dict(zip(distinct, np.bincount(number, minlength=len(distinct)).tolist())))
            words[b""] += n  # the end token
            key, _ = ppm.ngrams(*ppm.canonical(data, start, end, row, n))
            key.sort()
            key, count = ppm.runs(key, np.ones(len(key), np.int64))
            keys.append(key)
            counts.append(count)
            held += len(key)
            if held > SOME:
                merged = ppm.merged(keys, counts)
                keys, counts, held = [merged[0]], [merged[1]], len(merged[0])
                if held > SOME * 2 // 3:
                    yield gram_rows()
                    keys, counts, held = [], [], 0
            if len(words) > HELD_WORDS:
                yield word_rows()
    if keys:
        yield gram_rows()
    if words:
        yield word_rows()


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    near = (keys >> np.uint64(8 * (ppm.ORDER - ppm.NEAR))) & np.uint64((1 << 8 * ppm.NEAR) - 1)
    return (c.mix(near) % np.uint64(shards)).astype(np.int64)


def runs_by(part: np.ndarray, parts: int, key: np.ndarray, count: np.ndarray) -> list[tuple]:
    """(part, sum of counts, keys, counts) of each part that has any."""
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    at = [(k, order[a:b]) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
    return [(k, int(count[p].sum()), ppm.packed(key[p], WIDTH), ppm.packed(count[p], 5)) for k, p in at]


def _by_shard(batches, finish):
    """Merge the runs of one shard after the other; rows come sorted by shard."""
    at, ks, cs = None, [], []
    for batch in batches:
        for shard, keys, counts in zip(*(batch.column(k) for k in ("shard", "keys", "counts"))):
            if shard.as_py() != at:
                if ks:
                    yield finish(at, *ppm.merged(ks, cs))
                at, ks, cs = shard.as_py(), [], []
            ks.append(ppm.unpacked(keys.as_py(), WIDTH))
            cs.append(ppm.unpacked(counts.as_py(), 5).astype(np.int64))
            if sum(map(len, ks[1:])) > max(1 << 20, len(ks[0])):
                merged = ppm.merged(ks, cs)
                ks[:], cs[:] = [merged[0]], [merged[1]]
    if ks:
        yield finish(at, *ppm.merged(ks, cs))


def _low_rows(batches):
    return _by_shard(batches, lambda at, key, count: pa.RecordBatch.from_arrays(
        [pa.array([key.tobytes()], pa.binary()), pa.array([count.tobytes()], pa.binary())], ["keys", "counts"]))


class Low:
    """The orders below NEAR, which every shard needs."""

    def __init__(self, key: np.ndarray, count: np.ndarray, symbols: int):
        self.symbols, self.least = symbols, max(1.0, symbols / ppm.RARE)
        levels = [ppm.runs(key >> np.uint64(8 * (ppm.NEAR - 1 - k)), count) for k in range(ppm.NEAR)]
        self.levels = [(k[n >= self.least], n[n >= self.least]) for k, n in levels]
        self.trie = None

    def shard(self, key: np.ndarray, count: np.ndarray) -> ppm.Trie:
        """The trie of one shard from all of its n-grams of order ORDER."""
        if self.trie is None:
            self.trie = ppm.Trie(self.levels, self.symbols)
        levels, occurs = list(self.levels), {}
        for k in range(ppm.NEAR, WIDTH):
            some, n = ppm.shorter(key, count, k)
            if k > ppm.NEAR:
                occurs[k] = ppm.occurrences(some, n, k)
            levels.append((some[n >= self.least], n[n >= self.least]))
        return ppm.Trie(levels, self.symbols, occurs, self.trie)


def train_low(grams: DataFrame, symbols: int) -> Low:
    """At most 256 n-grams to the power of NEAR, whatever the input."""
    dealt = grams.filter("shard < 0").select("shard", "keys", "counts").repartition(LOW_PARTS, "shard").sortWithinPartitions("shard")
    rows = c.map_batches(dealt, _low_rows, "keys binary, counts binary").toArrow()
    key, count = (np.concatenate([np.zeros(0, t), *(np.frombuffer(x.as_py(), t) for x in rows.column(name))]) for name, t in (("keys", np.uint64), ("counts", np.int64)))
    order = np.argsort(key)
    return Low(key[order], count[order], symbols)


def _model_rows(low, share: int):
    """One row per shard: all its n-grams with their counts, and the code lengths of the frequent ones."""

    def run(batches):
        model = low.value

        def finish(at, key, count):
            top = key[count * share >= model.symbols]
            logs = model.shard(key, count).code_lengths(top) if len(top) else np.zeros(0)
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), *(pa.array([x], pa.binary()) for x in (ppm.packed(key, WIDTH), ppm.packed(count, 5), top.tobytes(), logs.tobytes()))],
                ["shard", "keys", "counts", "top", "logs"])

        yield from _by_shard(batches, finish)

    return run


_indexes: dict[str, ppm.Index] = {}


def forget() -> None:
    """Workers outlive their tasks: the index of a scoring goes before other work starts, and freed Arrow memory is returned."""
    _indexes.clear()
    pa.default_memory_pool().release_unused()


SCORED = ("doc_id long, row long, n_tokens long, log_sum double, known long, score double, rare array<struct<word:binary,n:int>>, "
          "shard int, keys binary, owners binary")
FIELDS = [x.split()[0] for x in SCORED.split(", ")]


def parts_of(shards: int, groups: int) -> int:
    """Tasks of a group: all groups together have about as many tasks as there are shards."""
    return -(-shards // groups)


def _misses(keys: list, owners: list, shards: int, groups: int) -> pa.RecordBatch:
    """Places that the broadcast n-grams do not cover, by group of shards; all of them go to the same one of each group's tasks."""
    key, owner = np.concatenate(keys), np.concatenate(owners)
    parts = parts_of(shards, groups)
    task = int(c.mix(owner[:1].astype(np.uint64))[0] % np.uint64(parts))
    part = shard_of(key, shards) % groups
    order = np.lexsort((key, part))
    bounds = np.searchsorted(part[order], np.arange(groups + 1))
    at = [(k, order[a:b]) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
    n = len(at)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()),
         pa.nulls(n, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))), pa.array([k * parts + task for k, _ in at], pa.int32()),
         pa.array([ppm.packed(key[p], WIDTH) for _, p in at], pa.binary()), pa.array([ppm.packed(owner[p], 8) for _, p in at], pa.binary())], FIELDS)


def _score(model, token: str, shards: int, groups: int):
    def run(batches):
        top, logs, frequent = model.value
        if token not in _indexes:
            forget()
            _indexes[token] = ppm.Index(top)
        index = _indexes[token]
        keys, owners, held = [], [], 0
        for batch in batches:
            place = batch.column("row").to_numpy()
            for first, data, offsets in c.text_slices(batch.column("text"), SLICE):
                n = len(offsets) - 1
                start, end, row = c.word_spans(data, offsets)
                number, distinct = vocabulary(data, start, end)
                known = np.fromiter((frequent.get(w, 0) for w in distinct), np.int64, len(distinct))
                count = known[number]
                tokens = np.bincount(row, minlength=n) + 1
                ends = frequent.get(b"", 0)
                word_logs = np.bincount(row, np.where(count > 0, np.log10(count + 0.1), 0), n) + np.log10(ends + 0.1)
                sure = np.bincount(row, count > 0, n).astype(np.int64) + (ends > 0)
                rest = np.flatnonzero(count == 0)
                pair, times = np.unique(row[rest] * len(distinct) + number[rest], return_counts=True)
                at, word = (pair // max(1, len(distinct)), pair % max(1, len(distinct)))
                rare = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(at, np.arange(n + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array([distinct[w] for w in word.tolist()], pa.binary()), pa.array(times.astype(np.int32))], ["word", "n"]))
                key, owner = ppm.ngrams(*ppm.canonical(data, start, end, row, n))
                found = index.find(key)
                hit = found >= 0
                score = np.bincount(owner[hit], logs[found[hit]], n).astype(np.float64)
                keys.append(key[~hit])
                owners.append(place[first + owner[~hit]])
                held += len(keys[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), batch.column("row").slice(first, n), pa.array(tokens.astype(np.int64)), pa.array(word_logs), pa.array(sure), pa.array(score), rare,
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], FIELDS)
                if held > MISSES:
                    yield _misses(keys, owners, shards, groups)
                    keys, owners, held = [], [], 0
        if held:
            yield _misses(keys, owners, shards, groups)

    return run


def _score_misses(low):
    """Score the places sent to each task of a group of shards; the group's model rows come first."""

    def run(batches):
        forget()
        model, at, trie = low.value, None, None
        ks, cs = [], []
        for batch in batches:
            for shard, counts, keys, owners in zip(*(batch.column(k) for k in ("shard", "counts", "keys", "owners"))):
                key = ppm.unpacked(keys.as_py(), WIDTH)
                if shard.as_py() != at:
                    # without model rows no training text has a context of this group
                    at, trie, ks, cs = shard.as_py(), None, [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                if counts.is_valid:
                    ks.append(key)
                    cs.append(ppm.unpacked(counts.as_py(), 5).astype(np.int64))
                    continue
                if trie is None:
                    trie = model.shard(*ppm.merged(ks, cs))
                row, which = np.unique(ppm.unpacked(owners.as_py(), 8).astype(np.int64), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.bincount(which, trie.code_lengths(key), len(row)))], ["row", "score"])

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shards = shards_of(texts)
    gathered = c.written(c.map_batches(texts.filter(~held_out()).select("text"), _gather(shards), GATHERED))
    counts = c.written(gathered.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("c")))
    grams = gathered.filter("shard IS NOT NULL")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    symbols = grams.filter("shard >= 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    low = spark.sparkContext.broadcast(train_low(grams, symbols))
    dealt = grams.filter("shard >= 0").select("shard", "keys", "counts").repartition(shards, "shard").sortWithinPartitions("shard")
    tries = c.written(c.map_batches(dealt, _model_rows(low, SHARED), "shard int, keys binary, counts binary, top binary, logs binary"))
    groups = groups_of(tries, shards)
    # at most SHARED n-grams have this share of all training bytes
    best = tries.select("top", "logs").toArrow()
    shared, logs = (np.concatenate([np.zeros(0, t), *(np.frombuffer(x.as_py(), t) for x in best.column(name))]) for name, t in (("top", np.uint64), ("logs", np.float64)))
    # at most FREQUENT words have this share of all tokens
    top = counts.filter((F.col("c") * FREQUENT >= total) | (F.col("word") == F.lit(bytearray()))).toArrow()
    frequent = dict(zip(top.column("word").to_pylist(), top.column("c").to_pylist()))
    model = spark.sparkContext.broadcast((shared, logs, frequent))
    token = str(id(model)) + c.shared_folder(spark)
    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    both = c.written(c.map_batches(numbered, _score(model, token, shards, groups), SCORED))
    scored = both.filter("shard IS NULL").drop("shard", "keys", "owners")
    parts = parts_of(shards, groups)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    sent = tries.withColumn("task", every).select((F.col("shard") % groups * parts + F.col("task")).alias("shard"), "counts", "keys", F.lit(None).cast("binary").alias("owners")).union(
        both.filter("shard IS NOT NULL").select("shard", F.lit(None).cast("binary"), "keys", "owners"))
    sent = sent.repartition(groups * parts, "shard").sortWithinPartitions("shard", F.col("counts").isNull())
    places = c.map_batches(sent, _score_misses(low), "row long, score double").select(
        "row", F.lit(0.0).alias("log_sum"), F.lit(0).cast("long").alias("known"), F.col("score").alias("gram_score"))
    rare = scored.select("row", F.inline("rare")).join(counts, "word", "left").select(
        "row", (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("log_sum"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).cast("long").alias("known"),
        F.lit(0.0).alias("gram_score"))
    extra = places.union(rare).groupBy("row").agg(F.sum("log_sum").alias("rare_sum"), F.sum("known").alias("rare_known"), F.sum("gram_score").alias("rare_score"))
    mass = np.log10(total + 0.1 * (distinct + 1))
    base = F.col("log_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(mass))
    return scored.drop("rare").join(extra, "row", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"))
