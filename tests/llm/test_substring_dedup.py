import hashlib
import random
from collections import Counter

import pytest

from offerlens.llm import queries, substring_dedup
from tests.llm.helpers import ODD_TEXTS, WORD, documents, prose, table

K = 35


def brute(rows):
    texts = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    counts = Counter(tuple(w[k: k + K]) for _, w in texts for k in range(len(w) - K + 1))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - K + 1):
            if counts[tuple(w[k: k + K])] > 1:
                gone.update(range(k, k + K))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def result(spark, rows):
    got = substring_dedup.remove_repeats(documents(spark, rows).repartition(3))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "score", "kept", "n_words", "n_removed"]
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [prose(rng, n).split() for n in (34, 35, 36, 60, 200, 200)]
    rows = []
    for i in range(80):
        words = prose(rng, rng.choice([5, 30, 80, 400])).split()
        for _ in range(rng.choice([0, 1, 2, 4])):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            b = rng.randrange(a, len(p)) + 1
            k = rng.randrange(len(words))
            words[k:k] = p if rng.random() < 0.5 else p[a:b]
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(words), "en", "a"))
    # near copies: one word replaced in each
    base = prose(rng, 300).split()
    for i in range(80, 110):
        words = list(base)
        words[rng.randrange(300)] = f"new{i}"
        rows.append((i, " ".join(words), "de", "b"))
    want = brute(rows)
    assert any(0 < r[2] < r[1] for r in want) and want == result(spark, rows)


def test_periodic_texts_repeats_in_one_document_and_odd_rows(spark):
    rng = random.Random(3)
    part = prose(rng, 50)
    rows = [(k, t, "en", None) for k, t in enumerate(ODD_TEXTS)] + [(None, t, "en", None) for t in ODD_TEXTS[:6]]
    rows += [(50, " ".join(["a"] * 35), "en", "a"), (51, " ".join(["b"] * 36), "en", "a"), (52, "x y z " * 60, "en", "a"), (53, f"{part} mid {part}", "en", "a")]
    rows += [(54, prose(rng, 90), "en", "a")] * 2 + [(54, prose(rng, 90), "en", "a")]
    assert brute(rows) == result(spark, rows)


def test_spans_name_the_passages(spark):
    rng = random.Random(4)
    passage = prose(rng, 120)
    own = [" ".join(f"u{i}x{k}" for k in range(60)) for i in range(12)]
    rows = [(i, f"{own[i]} {passage} {own[-i - 1].upper()}", "en", "a") for i in range(12)]
    spans = substring_dedup.repeated_spans(documents(spark, rows)).collect()
    assert {r.doc_id for r in spans} == set(range(12))
    assert all(60 <= r.start and r.start + r.n_words <= 180 for r in spans)
    # the passage is one compacted path from its first whole path to its last
    longest = Counter(r.span for r in spans if r.span is not None)
    assert len(longest) == 1 and set(longest.values()) == {12}


def test_whole_table_and_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    want = {(i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in brute(rows)}
    got = queries.op13(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(rows) and {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_empty_table(spark):
    assert result(spark, []) == []
