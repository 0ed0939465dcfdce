"""Spelling variant grouping by pivotal grams.

Words are maximal runs of letters (ASCII and U+00C0 to U+00FF), A-Z lowered. Every 31st run of a document, by the crc32 of
``<doc_id>:<run>``, loses one code point, as the contract's planted typing errors. Results of at least ``LEAST_LENGTH`` code
points that occur at least twice are words; two are near if one inserted, deleted or replaced code point turns one into the other.

1. Bigrams are ranked by the number of words that hold them, rarest first: an alphabet of 90 letters has at most 8100.
2. A word's prefix is its ``PREFIX`` rarest bigrams, with every occurrence of the last one. Among them dynamic programming
   chooses the two pivots: disjoint bigrams of the smallest total frequency. One edit spoils at most one of two disjoint
   bigrams. So if the prefix of s ends no later in the ranking than that of r, one pivot of s stands in r's prefix.
3. Position limits: an edit lies wholly right of the first pivot (then both words are equal up to its end), or wholly left of
   the second (then they are equal from its start on). What the edit leaves on its side narrows this down: its two
   letters nearest to the pivot are equal, or its two farthest. Prefix bigrams are indexed under these keys,
   pivots look them up, and lengths may differ by one.
4. Pairs that meet are verified: Levenshtein distance exactly 1.

The key carries at least four letters of the word with their place, so lists are short; nothing is capped, and a long list is split
by the skew join. Words pass through tasks in batches; counts combine before each exchange.

A word's form is its near word of the largest count, if that is ``TIMES`` its own; forms are followed to the last by doubling.
Counts grow tenfold at each step, so chains are short and have no cycles.

Null or empty texts have no runs; a null doc_id counts as empty text in the crc; a row that repeats counts again. Texts of any
length are read whole. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c

LEAST_LENGTH, LEAST_COUNT, TIMES, EVERY = 7, 2, 10, 31
PREFIX = 3
SLICE = 4 << 20
#: The first byte in UTF-8 of the letters from U+00C0 to U+00FF; the second is any that may follow.
LEAD = 0xC3


def _crc_table() -> np.ndarray:
    """State of the reflected CRC-32 after each byte, by its polynomial."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> np.uint32(1)) ^ np.where(state & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return state


_CRC = _crc_table()


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of letters."""
    folded = data | 0x20
    inside = ((folded >= 97) & (folded <= 122) & (data < 128)) | (data == LEAD)
    inside[1:] |= data[:-1] == LEAD
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opens = offsets[:-1][offsets[:-1] < len(data)]
    first[opens] |= inside[opens]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    closes = offsets[1:][offsets[1:] > 0] - 1
    last[closes] |= inside[closes]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, "right") - 1


def run_crcs(low: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run's bytes, going on from the crc ``before`` it; all runs advance byte by byte together."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    reg = before[order] ^ np.uint32(0xFFFFFFFF)
    begin, size = start[order], size[order]
    done = int(np.searchsorted(-size, -256, "left"))  # the few longer ones go to zlib
    for j in range(int(size[done]) if done < len(size) else 0):
        n = int(np.searchsorted(-size, -j, "left"))
        part = reg[done:n]
        reg[done:n] = _CRC[(part ^ low[begin[done:n] + j]) & 0xFF] ^ (part >> np.uint32(8))
    out = np.zeros(len(order), np.uint32)
    out[order] = reg ^ np.uint32(0xFFFFFFFF)
    for k in order[:done].tolist():
        out[k] = zlib.crc32(low[start[k]: end[k]].tobytes(), int(before[k]))
    return out


def words_of(data: np.ndarray, offsets: np.ndarray, ids: list[str]) -> pa.Array:
    """All words of a slice of texts, in no particular order, with repeats."""
    start, end, row = letter_runs(data, offsets)
    if not len(start):
        return pa.array([], pa.string())
    low = c.LOWER[data]
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    crc = run_crcs(low, start, end, seeds[row])
    leads = np.concatenate([[0], np.cumsum(data == LEAD)])
    points = end - start - (leads[end] - leads[start])
    hit = crc % EVERY == 0
    whole = ~hit & (points >= LEAST_LENGTH)
    size = np.where(whole, end - start, 0)
    mark = np.zeros(len(data) + 1, np.int32)
    np.add.at(mark, start[whole], 1)
    np.add.at(mark, end[whole], -1)
    letters = low[np.cumsum(mark[:-1]) > 0]
    bounds = np.concatenate([[0], np.cumsum(size[whole])]).astype(np.int32)
    plain = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.tobytes()), pa.py_buffer(letters.tobytes()))
    cut = []
    for k in np.flatnonzero(hit & (points > LEAST_LENGTH)).tolist():
        run = low[start[k]: end[k]].tobytes().decode()
        at = int(crc[k]) % len(run)
        cut.append(run[:at] + run[at + 1:])
    return pa.concat_arrays([plain, pa.array(cut, pa.string())])


def _count(batches):
    for batch in batches:
        ids = ["" if i is None else str(i) for i in batch.column("doc_id").to_pylist()]
        for first, data, offsets in c.text_slices(batch.column("text"), SLICE):
            counts = words_of(data, offsets, ids[first: first + len(offsets) - 1]).value_counts()
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: the words that occur often enough."""
    rows = docs.select("doc_id", F.col("text").cast("string"))
    counted = c.map_batches(rows, _count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """bigram -> (rank, words that hold it); at most 90 * 90 rows reach the driver."""
    grams = words.select(F.explode(F.array_distinct(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))"))).alias("g"))
    rows = grams.groupBy("g").agg(F.count("*").alias("n")).collect()
    return {r["g"]: (k, r["n"]) for k, r in enumerate(sorted(rows, key=lambda r: (r["n"], r["g"])))}


def pivots(places: list[int], weights: list[int]) -> tuple[int, int]:
    """The two disjoint places (two letters each, in rising order) of the smallest total weight.

    best[1][k]: the cheapest single gram that ends before the k-th; best[2] extends it by the k-th.
    """
    single, total, pair, behind = None, None, (0, 0), 0
    for place, weight in zip(places, weights):
        while places[behind] <= place - 2:
            if single is None or weights[behind] < single[0]:
                single = (weights[behind], places[behind])
            behind += 1
        if single is not None and (total is None or single[0] + weight < total):
            total, pair = single[0] + weight, (single[1], place)
    return pair


def signature(word: str, ranks: dict[str, tuple[int, int]], prefix: int = PREFIX) -> tuple[int, list[int], int, int]:
    """(rank of the prefix's last gram, places of its grams, first pivot, second pivot)."""
    grams = [ranks[word[i: i + 2]] for i in range(len(word) - 1)]
    last = sorted(grams)[min(prefix, len(grams)) - 1][0]
    places = [i for i, g in enumerate(grams) if g[0] <= last]
    left, right = pivots(places, [grams[i][1] for i in places])
    return last, places, left, right


def _signatures(ranks):
    def run(batches):
        for batch in batches:
            rows = [signature(w, ranks) for w in batch.column("word").to_pylist()]
            if rows:
                last, places, left, right = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word"), batch.column("n"), pa.array(last, pa.int32()), pa.array(places, pa.list_(pa.int32())),
                     pa.array(left, pa.int32()), pa.array(right, pa.int32())], ["word", "n", "last", "places", "left", "right"])

    return run


def _left_keys(i: str) -> str:
    """Keys of a word whose edit lies right of the bigram at ``i``, as SQL."""
    rest = f"length(word) - {i} - 2"
    return (f"IF({rest} >= 3, xxhash64('<+', substring(word, 1, {i} + 4)), NULL), "
            f"IF({rest} >= 3, xxhash64('<-', substring(word, 1, {i} + 2), right(word, 2)), NULL), "
            f"IF({rest} <= 3, xxhash64('<', substring(word, 1, {i} + 2)), NULL)")


def _right_keys(i: str) -> str:
    """Keys of a word whose edit lies left of the bigram at ``i``."""
    return (f"IF({i} >= 3, xxhash64('>+', substring(word, {i} - 1)), NULL), "
            f"IF({i} >= 3, xxhash64('>-', left(word, 2), substring(word, {i} + 1)), NULL), "
            f"IF({i} <= 3, xxhash64('>', substring(word, {i} + 1)), NULL)")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, na, nb: each pair of near words once, with their counts."""
    signed = c.written(c.map_batches(words, _signatures(gram_ranks(words)), "word string, n long, last int, places array<int>, left int, right int"))
    keys = signed.selectExpr("word", "n", "last", f"explode(filter(flatten(transform(places, i -> array({_left_keys('i')}, {_right_keys('i')}))), k -> k IS NOT NULL)) AS key")
    asks = signed.selectExpr("word", "n", "last", f"explode(filter(array({_left_keys('left')}, {_right_keys('right')}), k -> k IS NOT NULL)) AS key")
    a, b = asks.alias("a"), keys.alias("b")
    met = a.join(b, F.expr("""a.key = b.key AND a.last <= b.last AND abs(length(a.word) - length(b.word)) <= 1
        AND a.word <> b.word AND levenshtein(a.word, b.word, 1) = 1"""))
    low, high = F.struct("a.word", "a.n"), F.struct("b.word", "b.n")
    pairs = met.select(F.least(low, high).alias("x"), F.greatest(low, high).alias("y"))
    return pairs.distinct().selectExpr("x.word AS a", "x.n AS na", "y.word AS b", "y.n AS nb")


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n_near, form, form_n of the words that have near words; form is null where none is frequent enough."""
    both = pairs.select(F.explode(F.array(F.struct("a", "na", "b", "nb"), F.expr("struct(b AS a, nb AS na, a AS b, na AS nb)"))).alias("p")).select("p.*")
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.max("na").alias("n"), F.min(F.struct((-F.col("nb")).alias("less"), F.col("b").alias("form"))).alias("best"))
    enough = -F.col("best.less") >= TIMES * F.col("n")
    return best.select("word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """word, root: forms followed to the last one; each round doubles the steps that a row has taken."""
    at = c.written(links.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(further, "root", "left_semi").isEmpty():
            return at
        at = c.written(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    words = c.written(count_words(docs))
    found = c.written(forms(words, near_pairs(words)))
    c.release(docs.sparkSession)
    ends = roots(found.filter("form IS NOT NULL"))
    return words.join(found, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
