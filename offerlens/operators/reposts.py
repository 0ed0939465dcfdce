"""Repost detection: fingerprints, titles, description similarity, and the
ordered fold that decides which offers are canonical.

Nothing here groups a company into one task. Titles and fingerprints are
compared through aggregates, descriptions through a prefix-filtered set join
whose output is verified exactly.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.constants import SIMILARITY_THRESHOLD
from offerlens.functions import words
from offerlens.functions.text import SPACE_CLASS
from offerlens.operators.ordered import first_kept, ordered_choices
from offerlens.session import materialized

COMMON_TOKENS = 20_000
MAX_PAIRS = 2_000_000_000
CELL = 128
BUCKETS = 256
BROADCAST_IDS = 200_000
MEET = 3
ROWS, HELD = 512, 1_000_000
_EPS = 1e-9


# --- comparison keys -----------------------------------------------------------


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns, then the keys and the sorted words of texts in lower case."""
    sha = lambda text: hashlib.sha256(text).hexdigest()
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch, titles, prints, texts, held = whole.slice(at, ROWS), [], [], [], []
            # content: both token sequences, neither empty
            pairs = zip(*(batch.column(c).cast(pa.large_binary()).to_pylist() for c in ("title", "description")))
            for title, description in pairs:
                in_title, in_text = words.tokens(title), words.tokens(description)
                joined = b"\n".join(in_title)
                titles.append(sha(joined))
                prints.append(sha(b"\n\n".join((joined, b"\n".join(in_text)))) if in_title and in_text else None)
                in_text.sort()
                held.append(b" ".join(in_text))
                texts.append(sha(held[-1]))
            kept = [c for c in batch.schema.names if c not in ("title", "description")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(x, pa.string()) for x in (titles, prints)), pa.array(held, pa.binary()).cast(pa.string()), pa.array(texts, pa.string())],
                [*kept, "title_key", "fingerprint", "words", "text_key"])


def with_repost_keys(offers: DataFrame) -> DataFrame:
    """Add sorted description tokens (``words``, a space between them), title key, text key, fingerprint; drops the raw texts."""
    # lower case as everywhere in Spark; the rest of ``normalize_tokens`` is cheaper by whole texts
    lowered = offers.withColumns({
        **{f"has_{c}": F.coalesce(F.col(c).rlike(f"[^{SPACE_CLASS}]"), F.lit(False)) for c in ("title", "description")},
        **{c: F.lower(c) for c in ("title", "description")}})
    kept = T.StructType([f for f in lowered.schema.fields if f.name not in ("title", "description")])
    for name in ("title_key", "fingerprint", "words", "text_key"):
        kept = kept.add(name, "string")
    return lowered.mapInArrow(_keyed, kept)


def description_tokens() -> Column:
    """The tokens in ``words``."""
    return F.array_remove(F.split("words", " "), "")


# --- equality matches ------------------------------------------------------------


def fingerprint_matches(incoming: DataFrame, candidates: DataFrame) -> DataFrame:
    """(incoming_id, candidate_id): the first candidate with equal content."""
    first = candidates.filter("fingerprint IS NOT NULL").groupBy("company_id", "fingerprint").agg(
        F.min("offer_id").alias("candidate_id"))
    return incoming.join(first, ["company_id", "fingerprint"]).select(
        F.col("offer_id").alias("incoming_id"), "candidate_id")


def title_matches(incoming: DataFrame, candidates: DataFrame) -> DataFrame:
    """(incoming_id, candidate_id): the first candidate with equal title tokens.

    A candidate without a title is skipped; an incoming offer without one
    still equals a title that consists of separators only.
    """
    first = candidates.filter("has_title").groupBy("company_id", "title_key").agg(
        F.min("offer_id").alias("candidate_id"))
    return incoming.join(first, ["company_id", "title_key"]).select(
        F.col("offer_id").alias("incoming_id"), "candidate_id")


# --- description similarity ---------------------------------------------------------


def token_counts(offers: DataFrame) -> DataFrame:
    """Occurrences of every token per description."""
    return (
        offers.repartition("offer_id")
        .select("company_id", "offer_id", F.explode(description_tokens()).alias("token"))
        .groupBy("company_id", "offer_id", "token").agg(F.count(F.lit(1)).alias("n"))
    )


def _documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, docs) as far as a task has counted."""
    counts: Counter[bytes] = Counter()

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], ["token", "docs"])

    for batch in batches:
        for text in batch.column("words").cast(pa.large_binary()).to_pylist():
            counts.update(set(text.split()))
            if len(counts) > HELD:
                yield counted()
                counts.clear()
    yield counted()


def common_tokens(offers: DataFrame, k: int = COMMON_TOKENS) -> DataFrame:
    """The k most frequent tokens with their document counts (k bounds it)."""
    return (
        offers.select("words").mapInArrow(_documents_with, "token string, docs long")
        .groupBy("token").agg(F.sum("docs").alias("docs"))
        .orderBy(F.desc("docs"), "token").limit(k)
    )


def _common(ranks: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of tokens, in order, and their counts; one of no documents stands last."""
    names = [t.encode("utf-8", "surrogatepass") for t in ranks]
    ends = np.cumsum([0, *(len(t) for t in names)])
    h = words.hashes(np.frombuffer(b"".join(names), np.uint8), ends)[0] if names else np.zeros(0, np.uint64)
    order = np.argsort(h)
    return np.append(h[order], np.uint64(2**64 - 1)), np.append(np.array(list(ranks.values()), np.float64)[order], 0)


def _prefixes(common: tuple[np.ndarray, np.ndarray], threshold: float):
    """Per text its size, the rarest elements that any similar text shares ``MEET`` of (or all that they must share, if those are
    fewer), and its tokens counted by hash bucket (null if a count is out of range). Later occurrences of a token are elements of their own.

    Tokens and elements are 64-bit hashes here: equal hashes of unequal tokens make texts look more alike, so they only add candidates.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs = common
        for batch in batches:
            for first, end, data, offsets in words.slices(batch.column("words")):
                h, n = words.hashes(data, offsets)
                rows = len(n)
                row, start = np.repeat(np.arange(rows), n), np.cumsum(n) - n
                k = words.occurrences(h, row)
                place = np.searchsorted(known, h)
                # later occurrences of a token are rarer than the first one
                weight = np.where(known[place] == h, docs[place], 0) / (k * k)
                element = words.elements(h, k)
                level = weight.astype(np.float32).view(np.uint32) >> np.uint32(16)
                # equal keys keep the order of the words, which all texts share
                order = np.argsort(row.astype(np.uint64) << np.uint64(48) | level.astype(np.uint64) << np.uint64(32) | element >> np.uint64(32), kind="stable")
                least = np.minimum(n - np.ceil(n * threshold - _EPS).astype(np.int64) + MEET, n)
                rarest = element[order][np.arange(len(h)) - start[row] < least[row]]
                sketch = np.bincount(row * BUCKETS + (h % BUCKETS).astype(np.int64), minlength=rows * BUCKETS)
                beyond = sketch.reshape(rows, BUCKETS).max(1) >= 1 << 15
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, end - first) for c in ("company_id", "text_id")), pa.array(n, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(least)), pa.int32()), pa.array(rarest.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * BUCKETS, pa.int32()), pa.array(np.minimum(sketch, (1 << 15) - 1), pa.int16()), mask=pa.array(beyond))],
                    ["company_id", "text_id", "n", "elements", "sketch"])

    return convert


class Texts(NamedTuple):
    """Distinct descriptions of one side. members: company_id, offer_id, text_id (the smallest offer_id with the text);
    prefixes: company_id, text_id, n, elements, sketch; tokens: text_id, words."""

    members: DataFrame
    prefixes: DataFrame
    tokens: DataFrame

    def of(self, offers: DataFrame) -> Texts:
        """The texts of some of the offers."""
        members = self.members.join(offers.select("offer_id"), "offer_id", "left_semi")
        return Texts(members, self.prefixes.join(members.select("text_id").distinct(), "text_id", "left_semi"), self.tokens)


def distinct_texts(offers: DataFrame, common: DataFrame, threshold: float = SIMILARITY_THRESHOLD) -> Texts:
    """Copies are one text from here on. ``offers`` should be written: it is read for the texts' prefixes and for their tokens.

    A description without tokens becomes one marker element: such descriptions equal each other only.
    """
    described = offers.filter("has_description")
    first = described.groupBy("company_id", "text_key").agg(F.min("offer_id").alias("text_id"))
    members = materialized(described.select("company_id", "offer_id", "text_key").join(first, ["company_id", "text_key"]).select("company_id", "offer_id", "text_id"))
    tokens = described.select("company_id", F.col("offer_id").alias("text_id"), "words")
    ranks = _common({r["token"]: r["docs"] for r in common.collect()})
    kind = tokens.schema["company_id"].dataType.simpleString()
    every = tokens.mapInArrow(_prefixes(ranks, threshold), f"company_id {kind}, text_id long, n int, elements array<long>, sketch array<smallint>")
    prefixes = materialized(every.join(members.select("text_id").distinct(), "text_id", "left_semi"))
    return Texts(members, prefixes, tokens.select("text_id", "words"))


def _length(n: Column | str) -> Column:
    """Lengths within a factor of 1.5 are one class, longer ones a later one."""
    return F.floor(F.log(1.5, n)).cast("int")


def _lengths(n: str, threshold: float) -> Column:
    """The classes of all lengths that a similar text can have."""
    low, high = F.greatest(F.lit(1), F.ceil(F.col(n) * threshold - _EPS)), F.floor((F.col(n) + _EPS) / threshold)
    return F.sequence(_length(low), _length(high))


def _keys(prefixes: DataFrame, side: str, length: Column) -> DataFrame:
    # equal keys of unequal elements only add candidates
    return prefixes.select("company_id", F.col("text_id").alias(f"{side}_id"), F.col("n").alias(f"{side}_n"), length.alias("length"), "elements").select(
        "company_id", f"{side}_id", f"{side}_n", "length", F.posexplode("elements").alias(f"{side}_pos", "element")).select(
        F.xxhash64("company_id", "element", "length").alias("key"), "company_id", "length", f"{side}_id", f"{side}_n", f"{side}_pos")


def _overlaps(threshold: float):
    """Rows of a cell: its texts (kind 0, side, id, words), then its pairs (kind 1, id, other). Returns the similar pairs."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for batch in batches:
            left, right, found = [], [], []
            texts = batch.column("words")
            for row, (root, i, j, kind, side, one, other) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "kind", "side", "id", "other")))):
                if (root, i, j) != cell:
                    cell, held = (root, i, j), {}
                if kind == 0:
                    tokens = texts[row].as_py().split(" ")
                    held[side, one] = len(tokens), Counter(tokens)
                    continue
                (n, a), (m, b) = held[0, one], held[1, other]
                if len(a) > len(b):
                    a, b = b, a
                similarity = sum(min(c, b[t]) for t, c in a.items() if t in b) / max(n, m)
                if similarity >= threshold:
                    left.append(one)
                    right.append(other)
                    found.append(similarity)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64()), pa.array(found, pa.float64())], ["left_id", "right_id", "similarity"])

    return convert


def _possible(pairs: DataFrame, left: Texts, right: Texts, threshold: float) -> DataFrame:
    """The pairs whose bucket counts leave room for enough common tokens: what two texts share they share bucket by bucket."""
    side = lambda t, name: t.prefixes.select(F.col("text_id").alias(f"{name}_id"), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))
    common = F.aggregate(F.zip_with("left_sketch", "right_sketch", lambda a, b: F.least(a, b).cast("int")), F.lit(0), lambda total, c: total + c)
    return pairs.join(side(left, "left"), "left_id").join(side(right, "right"), "right_id").filter(
        F.coalesce(common, F.col("left_n")) >= F.greatest("left_n", "right_n") * threshold - _EPS).select("left_id", "right_id")


def similar_pairs(left: Texts, right: Texts, condition: Column | None = None, threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """(left_id, right_id, similarity) of texts with similarity >= threshold.

    ``condition`` may use left_id and right_id. Candidates meet on (company, rare element, class of lengths), ``MEET`` times or as often as they must share
    elements; before they are counted no more than their ids is sent. They must pass the length and
    position bounds and that of the bucket counts; every surviving pair is counted exactly. Near copies meet in cells of at most about ``CELL`` texts a side, so a
    text is sent once per cell and not once per pair: those whose right text has the same first left text lie together.
    """
    longest = F.greatest("left_n", "right_n")
    room = F.least(F.col("left_n") - F.col("left_pos"), F.col("right_n") - F.col("right_pos"))
    enough = longest * threshold - _EPS
    # behind the k-th element that two texts share there is room for all but k - 1 of the others
    on = (F.least("left_n", "right_n") >= enough) & (room >= enough - (MEET - 1))
    if condition is not None:
        on = on & condition
    keys = _keys(left.prefixes, "left", _length("n")), _keys(right.prefixes, "right", F.explode(_lengths("n", threshold)))
    met = keys[0].join(keys[1], ["key", "company_id"]).filter(on).select(
        "left_id", "right_id", F.least(F.lit(MEET), F.ceil(enough)).cast("int").alias("least")).groupBy("left_id", "right_id").agg(
        F.count(F.lit(1)).alias("times"), F.max("least").alias("least")).filter("times >= least").select("left_id", "right_id")
    candidates = materialized(_possible(met, left, right, threshold))
    first = candidates.groupBy("right_id").agg(F.min("left_id").alias("root"))
    rooted = candidates.join(first, "right_id")
    sizes = rooted.groupBy("root").agg(F.count_distinct("left_id").alias("lefts"), F.count_distinct("right_id").alias("rights"))

    def block(name: str, size: str) -> Column:
        return F.pmod(F.xxhash64(name), F.ceil(F.col(size) / CELL))

    pairs = materialized(rooted.join(sizes, "root").select("root", block("left_id", "lefts").alias("i"), block("right_id", "rights").alias("j"), "left_id", "right_id"))
    ids = materialized(pairs.select(F.explode(F.array("left_id", "right_id")).alias("text_id")).distinct())
    few = ids.count() <= BROADCAST_IDS
    cell, none = ["root", "i", "j"], F.lit(None).cast("long")
    sides = [
        pairs.select(*cell, F.col(f"{name}_id").alias("text_id")).distinct().join(
            texts.tokens.join(F.broadcast(ids), "text_id", "left_semi") if few else texts.tokens, "text_id").select(
            *cell, F.lit(0).alias("kind"), F.lit(side).alias("side"), F.col("text_id").alias("id"), none.alias("other"), "words")
        for side, (name, texts) in enumerate((("left", left), ("right", right)))]
    asked = pairs.select(*cell, F.lit(1).alias("kind"), F.lit(0).alias("side"), F.col("left_id").alias("id"), F.col("right_id").alias("other"),
                         F.lit(None).cast("string").alias("words"))
    rows = _union([*sides, asked]).repartition(*cell).sortWithinPartitions(*cell, "kind")
    return materialized(rows.mapInArrow(_overlaps(threshold), "left_id long, right_id long, similarity double"))


def estimated_pairs(prefixes: DataFrame, threshold: float = SIMILARITY_THRESHOLD) -> float:
    """Upper bound of the candidate rows a self join of the texts would make."""
    asked = _keys(prefixes, "right", F.explode(_lengths("n", threshold)))
    per_element = asked.groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("asks"), F.count_if(F.col("length") == _length("right_n")).cast("double").alias("own"))
    return per_element.agg(F.sum(F.col("own") * (F.col("asks") - 1) / 2).alias("s")).first()["s"] or 0.0


def best_similar(
    incoming: DataFrame, candidates: DataFrame, threshold: float = SIMILARITY_THRESHOLD
) -> DataFrame:
    """(incoming_id, candidate_id, similarity): the most similar candidate.

    Ties go to the latest ``seen_at`` (a missing one last), then the smallest
    id. Candidates are canonical offers, hence unlike each other, so an
    incoming offer meets few of them.
    """
    common = materialized(common_tokens(candidates))
    held, asked = distinct_texts(candidates, common, threshold), distinct_texts(incoming, common, threshold)
    similar = similar_pairs(held, asked, threshold=threshold)
    # canonical offers have a text each, of several the choice below decides
    seen = held.members.select("offer_id", F.col("text_id").alias("left_id")).join(candidates.select("offer_id", "seen_at"), "offer_id")
    options = similar.join(seen, "left_id").select(F.col("right_id").alias("text_id"), F.col("offer_id").alias("left_id"), "seen_at", "similarity")
    pairs = options.join(asked.members.select("text_id", F.col("offer_id").alias("right_id")), "text_id")
    return (
        pairs.groupBy("right_id")
        .agg(F.max(F.struct("similarity", "seen_at", (-F.col("left_id")).alias("o"))).alias("b"))
        .select(F.col("right_id").alias("incoming_id"), (-F.col("b.o")).alias("candidate_id"),
                "b.similarity")
    )


def shares_token(incoming: DataFrame, candidates: DataFrame) -> DataFrame:
    """incoming_id of offers that have a token in common with any candidate."""
    vocabulary = candidates.select(
        "company_id", F.explode(description_tokens()).alias("token")).distinct()
    asked = incoming.select(
        "company_id", F.col("offer_id").alias("incoming_id"),
        F.explode(F.array_distinct(description_tokens())).alias("token"))
    return asked.join(vocabulary, ["company_id", "token"], "left_semi").select("incoming_id").distinct()


def decide(
    incoming: DataFrame, candidates: DataFrame, threshold: float = SIMILARITY_THRESHOLD
) -> DataFrame:
    """Decision per incoming offer against a fixed candidate set.

    Both sides carry repost keys. Returns (offer_id, is_duplicate, reason,
    candidate_id, similarity, candidates).
    """
    counts = candidates.groupBy("company_id").agg(F.count(F.lit(1)).alias("candidates"))
    titles = title_matches(incoming, candidates).select(
        F.col("incoming_id").alias("offer_id"), F.col("candidate_id").alias("title_id"))
    open_ = incoming.filter("has_description").join(titles, "offer_id", "left_anti")
    best = best_similar(open_, candidates, threshold).select(
        F.col("incoming_id").alias("offer_id"), F.col("candidate_id").alias("similar_id"), "similarity")
    near = shares_token(
        open_.join(best, "offer_id", "left_anti"), candidates.filter("has_description")
    ).select(F.col("incoming_id").alias("offer_id"), F.lit(True).alias("shares"))
    joined = (
        incoming.select("offer_id", "company_id", "has_description")
        .join(counts, "company_id", "left").join(titles, "offer_id", "left")
        .join(best, "offer_id", "left").join(near, "offer_id", "left")
    )
    reason = (
        F.when(F.col("candidates").isNull(), "no_candidates")
        .when(F.col("title_id").isNotNull(), "exact_title")
        .when(~F.col("has_description"), "missing_description")
        .when(F.col("similar_id").isNotNull(), "desc_similarity")
        .when(F.col("shares"), "desc_below_threshold")
        .otherwise("title_mismatch")
    )
    return joined.select(
        "offer_id", reason.isin("exact_title", "desc_similarity").alias("is_duplicate"),
        reason.alias("reason"), F.coalesce("title_id", "similar_id").alias("candidate_id"),
        "similarity", F.coalesce("candidates", F.lit(0).cast("long")).alias("candidates"))


# --- ordered fold ------------------------------------------------------------------


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _resolve(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Canonical offers among ``nodes`` (company_id, offer_id, title_key,
    has_title, text_id), where ``pairs`` (left_id, right_id) are similar texts.

    An offer is canonical when no earlier canonical one equals it. Titles and texts are
    keys that their offers share; an offer also asks for the texts similar to its own. So copies
    are not paired up; see ``ordered.first_kept``.
    """
    title = F.concat_ws("\n", F.lit("t"), F.col("company_id").cast("string"), "title_key")
    text = lambda c: F.concat_ws("\n", F.lit("d"), F.col(c).cast("string"))
    yes, no, item = F.lit(True), F.lit(False), F.col("offer_id").alias("item")
    described = nodes.filter("text_id IS NOT NULL")
    claims = _union([
        nodes.select(item, title.alias("key"), F.col("has_title").alias("holds"), yes.alias("asks")),
        described.select(item, text("text_id").alias("key"), yes.alias("holds"), yes.alias("asks")),
        described.join(_both_ways(pairs).withColumnRenamed("right_id", "text_id"), "text_id").select(item, text("left_id").alias("key"), no.alias("holds"), yes.alias("asks"))])
    return nodes.join(first_kept(claims).withColumnRenamed("item", "offer_id"), "offer_id", "left_semi")


def _both_ways(pairs: DataFrame) -> DataFrame:
    turned = pairs.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "similarity")
    return pairs.select(*turned.columns).unionByName(turned)


def canonical_offers(nodes: DataFrame, texts: Texts, threshold: float, max_pairs: float) -> tuple[DataFrame, DataFrame | None]:
    """Canonical offers in arrival order, and the similar texts if one window held all.

    ``nodes``: company_id, offer_id, title_key, has_title, text_id. When the candidate join would exceed ``max_pairs`` rows (a big cluster of
    near copies), only the earliest part is resolved; its canonical offers
    then remove their copies from the rest, and the next part follows. All
    copies are still compared, but with canonical offers instead of each other.
    """
    found: list[DataFrame] = []
    rest = nodes
    while True:
        window, cut = rest, None
        window_texts = texts.of(window) if found else texts
        cost = estimated_pairs(window_texts.prefixes, threshold)
        while cost > max_pairs:
            share = max(0.05, min(0.7, (max_pairs / cost) ** 0.5))
            lo, cut_at = window.approxQuantile("offer_id", [0.0, share], 0.01)
            if cut is not None and cut_at >= cut:
                cut_at = (lo + cut) // 2
            if cut_at <= lo:
                break
            cut = cut_at
            window = rest.filter(F.col("offer_id") <= cut)
            window_texts = texts.of(window)
            cost = estimated_pairs(window_texts.prefixes, threshold)
        pairs = similar_pairs(window_texts, window_texts, F.col("left_id") < F.col("right_id"), threshold)
        canon = materialized(_resolve(window, pairs))
        found.append(canon)
        if cut is None:
            return _union(found), (pairs if len(found) == 1 else None)
        later = rest.filter(F.col("offer_id") > cut)
        copies = similar_pairs(texts.of(canon), texts.of(later), threshold=threshold).select(F.col("right_id").alias("text_id")).distinct()
        taken = canon.filter("has_title").select("company_id", "title_key").distinct()
        rest = materialized(later.join(taken, ["company_id", "title_key"], "left_anti").join(copies, "text_id", "left_anti"))
        if rest.isEmpty():
            return _union(found), None


def canonical_candidates(offers: DataFrame) -> DataFrame:
    """Offers that are no reposts themselves: what arriving offers are compared with."""
    return offers.filter("canonical_offer_id IS NULL")


def fold_reposts(
    arrivals: DataFrame,
    stored: DataFrame | None = None,
    threshold: float = SIMILARITY_THRESHOLD,
    max_pairs: float = MAX_PAIRS,
) -> DataFrame:
    """Fold arriving offers, in ``offer_id`` order, into the canonical set.

    ``arrivals``: company_id, offer_id (arrival order), title, description,
    seen_at, or a written table of them with repost keys. ``stored``: the same columns plus content_fingerprint, from_seq
    and until_seq for offers that are already canonical; their ids come before
    all arrivals, and a version counts for arrivals inside (from_seq,
    until_seq), open when null.

    Returns one row per arrival: company_id, offer_id, is_repost,
    canonical_id, reason, similarity, seen_at.
    """
    base = arrivals if "text_key" in arrivals.columns else materialized(with_repost_keys(
        arrivals.select("company_id", "offer_id", "title", "description", "seen_at")))
    common = materialized(common_tokens(base))
    texts = distinct_texts(base, common, threshold)
    placed = texts.members.select("offer_id", "text_id")
    no_long = F.lit(None).cast("long")
    static_pairs = None
    if stored is None:
        known = base.select("company_id", "offer_id", "title_key", "has_title", "fingerprint",
                            "seen_at", no_long.alias("fp_id"), no_long.alias("title_id"))
        open_nodes = known
    else:
        # versions of one stored offer are told apart by a key of their own; the hash would skip nulls
        none = F.lit(-1).cast("long")
        version = F.xxhash64("offer_id", F.coalesce("from_seq", none), F.coalesce("until_seq", none))
        versions = materialized(with_repost_keys(stored.withColumn("version_id", version)))
        alive = (
            (F.col("from_seq").isNull() | (F.col("from_seq") < F.col("offer_id")))
            & (F.col("until_seq").isNull() | (F.col("offer_id") < F.col("until_seq")))
        )
        fp = versions.filter("content_fingerprint IS NOT NULL").groupBy(
            "company_id", F.col("content_fingerprint").alias("fingerprint")
        ).agg(F.min("offer_id").alias("fp_id"))
        titles = versions.filter("has_title").groupBy(
            "company_id", "title_key", "from_seq", "until_seq"
        ).agg(F.min("offer_id").alias("stored_id"))
        title_hit = (
            base.select("company_id", "title_key", "offer_id")
            .join(titles, ["company_id", "title_key"]).filter(alive)
            .groupBy("offer_id").agg(F.min("stored_id").alias("title_id"))
        )
        known = materialized(
            base.select("company_id", "offer_id", "title_key", "has_title", "fingerprint", "seen_at")
            .join(fp, ["company_id", "fingerprint"], "left").join(title_hit, "offer_id", "left"))
        stored_texts = distinct_texts(versions.withColumn("offer_id", F.col("version_id")), common, threshold)
        unmatched = texts.of(known.filter("fp_id IS NULL AND title_id IS NULL"))
        kept_as = versions.select("version_id", "from_seq", "until_seq", F.col("offer_id").alias("left_id"), F.col("seen_at").alias("left_seen_at")).join(
            stored_texts.members.select(F.col("offer_id").alias("version_id"), F.col("text_id").alias("left_text")), "version_id").drop("version_id")
        live = (
            (F.col("from_seq").isNull() | (F.col("from_seq") < F.col("right_id")))
            & (F.col("until_seq").isNull() | (F.col("right_id") < F.col("until_seq")))
        )
        static_pairs = materialized(
            similar_pairs(stored_texts, unmatched, threshold=threshold).withColumnsRenamed({"left_id": "left_text", "right_id": "text_id"})
            .join(unmatched.members.select("company_id", "text_id", F.col("offer_id").alias("right_id")), "text_id")
            .join(kept_as, "left_text").filter(live)
            .select("company_id", "left_id", "right_id", "similarity", "left_seen_at"))
        open_nodes = known.filter("fp_id IS NULL AND title_id IS NULL").join(
            static_pairs.select(F.col("right_id").alias("offer_id")).distinct(),
            "offer_id", "left_anti")
    nodes = materialized(open_nodes.select("company_id", "offer_id", "title_key", "has_title").join(placed, "offer_id", "left"))
    canon, pairs = canonical_offers(nodes, texts if stored is None else texts.of(nodes), threshold, max_pairs)
    canon = materialized(known.join(canon.select("offer_id"), "offer_id", "left_semi"))

    reposts = known.join(canon.select("offer_id"), "offer_id", "left_anti")
    new_fp = canon.filter("fingerprint IS NOT NULL").groupBy("company_id", "fingerprint").agg(
        F.min("offer_id").alias("new_fp_id"))
    new_title = canon.filter("has_title").groupBy("company_id", "title_key").agg(
        F.min("offer_id").alias("new_title_id"))
    earlier = lambda c: F.when(F.col(c) < F.col("offer_id"), F.col(c))
    matched = (
        reposts.join(new_fp, ["company_id", "fingerprint"], "left")
        .join(new_title, ["company_id", "title_key"], "left")
        .select("company_id", "offer_id", "seen_at", F.coalesce(
            "fp_id", earlier("new_fp_id"), "title_id", earlier("new_title_id")).alias("equal_id"))
    )
    by_text = materialized(
        matched.filter("equal_id IS NULL").select("company_id", "offer_id", "seen_at"))
    text_of = lambda offers: offers.join(placed, "offer_id")
    if pairs is None or stored is not None:
        links = similar_pairs(texts.of(canon), texts.of(by_text), threshold=threshold)
    else:
        same = placed.select(F.col("text_id").alias("left_id"), F.col("text_id").alias("right_id"), F.lit(1.0).alias("similarity")).distinct()
        links = _both_ways(pairs).unionByName(same)
    left = text_of(canon.select("offer_id", F.col("seen_at").alias("left_seen_at"))).withColumnsRenamed({"offer_id": "left_id", "text_id": "left_text"})
    right = text_of(by_text.select("company_id", "offer_id")).withColumnsRenamed({"offer_id": "right_id", "text_id": "right_text"})
    options = links.withColumnsRenamed({"left_id": "left_text", "right_id": "right_text"}).join(right, "right_text").join(left, "left_text").filter(
        "left_id < right_id").select("company_id", "left_id", "right_id", "similarity", "left_seen_at")
    if static_pairs is not None:
        options = options.unionByName(static_pairs)
    options = options.join(by_text.select(F.col("offer_id").alias("right_id")), "right_id", "left_semi")
    equal = matched.filter("equal_id IS NOT NULL").select(
        F.col("equal_id").alias("left_id"), F.col("offer_id").alias("right_id"), "seen_at")
    chosen = _choose(options, equal, by_text)
    return (
        known.select("company_id", "offer_id", "seen_at")
        .join(matched.select("offer_id", "equal_id"), "offer_id", "left")
        .join(chosen, "offer_id", "left")
        .select(
            "company_id", "offer_id",
            F.coalesce("equal_id", "similar_id").isNotNull().alias("is_repost"),
            F.coalesce("equal_id", "similar_id").alias("canonical_id"),
            F.when(F.col("equal_id").isNotNull(), "exact_title")
            .when(F.col("similar_id").isNotNull(), "desc_similarity").alias("reason"),
            F.when(F.col("equal_id").isNull(), F.col("similarity")).alias("similarity"),
            "seen_at",
        )
    )


def _choose(options: DataFrame, equal: DataFrame, by_text: DataFrame) -> DataFrame:
    """(offer_id, similar_id, similarity): the best canonical offer per repost.

    Equal similarity goes to the candidate seen last, and a candidate is seen
    again by each earlier repost of it. So reposts with a single best option
    are settled first; tied ones follow in order within each set of candidates
    that they connect (``ordered.ordered_choices``).
    """
    best = options.groupBy("right_id").agg(F.max("similarity").alias("similarity"))
    tops = materialized(
        options.join(best, ["right_id", "similarity"]).dropDuplicates(["left_id", "right_id"]))
    sizes = tops.groupBy("right_id").agg(F.count(F.lit(1)).alias("n"))
    seen = by_text.select(F.col("offer_id").alias("right_id"), "seen_at")
    single = tops.join(sizes.filter("n = 1"), "right_id").join(seen, "right_id").select(
        "left_id", "right_id", "seen_at", "similarity")
    tied = materialized(tops.join(sizes.filter("n > 1"), "right_id").join(seen, "right_id"))
    done = single
    if not tied.isEmpty():
        asks = tied.select(F.col("right_id").alias("item"), F.col("left_id").alias("option"), F.col("left_seen_at").alias("start"), F.col("seen_at").alias("value"))
        events = _union([equal.select("left_id", "right_id", "seen_at"), single.select("left_id", "right_id", "seen_at")]).select(
            F.col("right_id").alias("item"), F.col("left_id").alias("option"), F.col("seen_at").alias("value"))
        open_events = events.join(asks.select("option").distinct(), "option", "left_semi")
        chosen = ordered_choices(asks, open_events).select(F.col("item").alias("right_id"), F.col("option").alias("left_id"))
        done = single.unionByName(tied.join(chosen, ["right_id", "left_id"], "left_semi").select(*single.columns))
    return done.select(F.col("right_id").alias("offer_id"), F.col("left_id").alias("similar_id"), "similarity")


# --- set-based output modes -----------------------------------------------------------


def mark_duplicates(offers: DataFrame, folded: DataFrame) -> DataFrame:
    """Keep every offer, repeats flagged with their canonical offer."""
    marks = folded.filter("is_repost").select("offer_id", F.col("canonical_id").alias("mark"))
    return offers.join(marks, "offer_id", "left").withColumn(
        "canonical_offer_id", F.coalesce("mark", "canonical_offer_id")).drop("mark")


def repost_counters(folded: DataFrame) -> DataFrame:
    """(canonical_id, reposts, last_seen_at): last_seen_at is the latest
    arrival's value, not the greatest one."""
    return folded.filter("is_repost").groupBy("canonical_id").agg(
        F.count(F.lit(1)).alias("reposts"), F.max_by("seen_at", "offer_id").alias("last_seen_at"))


def apply_repost_counters(offers: DataFrame, counters: DataFrame) -> DataFrame:
    new = counters.select(
        F.col("canonical_id").alias("offer_id"), "reposts", F.col("last_seen_at").alias("new_seen"))
    return offers.join(new, "offer_id", "left").withColumns({
        "repost_count": F.col("repost_count") + F.coalesce("reposts", F.lit(0).cast("long")),
        "last_seen_at": F.coalesce("new_seen", "last_seen_at"),
    }).drop("reposts", "new_seen")
