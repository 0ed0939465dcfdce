import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from offerlens.llm import common as c
from offerlens.llm import spelling
from tests.llm.helpers import ODD_TEXTS, documents, lower, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows):
    out = Counter()
    for i, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k + (len(a) > len(b)):] == b[k + (len(b) > len(a)):]


def brute(rows):
    n = brute_words(rows)
    cuts = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            cuts[w[:k] + w[k + 1:]].add(w)
    partners = {w: {x for k in range(len(w)) for x in cuts[w[:k] + w[k + 1:]] | ({w[:k] + w[k + 1:]} & n.keys()) if near(w, x)} | {x for x in cuts[w] if near(w, x)} for w in n}
    form = {}
    for w, p in partners.items():
        best = min(p, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(partners[w]), n[form[w]] if form[w] else None))
    return out


def result(spark, rows):
    got = spelling.group_variants(documents(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return got.collect()


def typo(rng, word):
    k = rng.randrange(len(word))
    letter = rng.choice("abcàéß")
    return rng.choice([word[:k] + word[k + 1:], word[:k] + letter + word[k:], word[:k] + letter + word[k + 1:], word])


@pytest.mark.parametrize("letters", ["ab", "abcdefé", "abcdefghijklmnopqrstuvwxyzàéîõüß"])
def test_equals_brute_force(spark, letters):
    rng = random.Random(len(letters))
    stems = ["".join(rng.choice(letters) for _ in range(rng.choice([7, 7, 8, 9, 12]))) for _ in range(60)]
    rows = []
    for i in range(120):
        words = [stems[int(rng.paretovariate(0.6)) % 60] for _ in range(60)]
        words = [typo(rng, w) if rng.random() < 0.2 else w for w in words]
        rows.append((i, rng.choice([" ", ", ", "1"]).join(words).title() if i % 3 else " ".join(words), "en", "a"))
    want = brute(rows)
    assert any(w[1] for w in want) and sorted(want, key=lambda r: r[0]) == sorted(map(tuple, result(spark, rows)))


def test_chains_ties_and_odd_rows(spark):
    words = ["abcdefgh"] * 1100 + ["abcdefgi"] * 110 + ["abcdefji"] * 11 + ["zbcdefgh"] * 1100 + ["bbcdefghh"] * 5 + ["bcdefgh"] * 2
    rows = [(None, t, "en", None) for t in ODD_TEXTS] + [(7, " ".join(words), "en", "a"), (7, "äöü×÷ÿÀ Straße-NAÏVETÉ " * 40, None, None), (7, "äöü×÷ÿÀ Straße-NAÏVETÉ " * 40, None, None)]
    want = brute(rows)
    got = result(spark, rows)
    assert sorted(want, key=lambda r: r[0]) == sorted(map(tuple, got))
    by = {r.word: r for r in got}
    assert by["abcdefji"].root == "abcdefgh" and by["abcdefji"].form == "abcdefgi"


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    got = spelling.group_variants(table(spark, "documents")).collect()
    assert sorted(brute(rows), key=lambda r: r[0]) == sorted(map(tuple, got))


def test_empty_table(spark):
    assert result(spark, []) == []


def test_crcs_of_short_and_long_runs():
    texts = [b"a", b"bc" * 127, b"d" * 255, b"e" * 256, b"f" * 257, b"g" * 5000]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    before = np.array([zlib.crc32(f"{k}:".encode()) for k in range(len(texts))], np.uint32)
    got = spelling.run_crcs(c.LOWER[data], ends - [len(t) for t in texts], ends, before)
    assert got.tolist() == [zlib.crc32(f"{k}:".encode() + t) for k, t in enumerate(texts)]


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(5)
    for _ in range(500):
        places = sorted(rng.sample(range(12), rng.randint(3, 7)))
        weights = [rng.randint(1, 9) for _ in places]
        cost = dict(zip(places, weights))
        a, b = spelling.pivots(places, weights)
        assert b - a >= 2 and cost[a] + cost[b] == min(cost[x] + cost[y] for x in places for y in places if y - x >= 2)
