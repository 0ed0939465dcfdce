import hashlib
import math
import random
from collections import Counter

from offerlens.llm import mixing
from tests.llm.helpers import ODD_TEXTS, documents, prose


def draw(rate, ident, seed):
    parts = max(1, math.ceil(rate / mixing.MAX_RATE))
    total = 0
    for part in range(1, parts + 1):
        u = (int(hashlib.md5(f"{seed}|{ident}|{part}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        k, p = 0, math.exp(-rate / parts)
        s = p
        while s <= u and k < mixing.MOST:
            k += 1
            p *= rate / parts / k
            s += p
        total += k
    return total


def test_against_brute_force_and_weights(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 5), "en", "big") for i in range(900)] + [(i, prose(rng, 5), "en", "small") for i in range(900, 990)]
    rows += [(i, t, None, None) for i, t in enumerate(ODD_TEXTS)] + [(None, "n", None, None)] * 2 + [(5000, "single", "x", "one")]
    docs = documents(spark, rows).withColumnRenamed("kept", "copy")
    weights = {"big": 1.0, "small": 1.0, "one": 0.2}
    got = mixing.mix_sources(docs, weights, other=0.05, seed="t")
    assert got.columns == [x for x in docs.columns if x != "copy"] + ["copy", "shuffle_key"]
    counts = Counter((r.doc_id, r.text, r.source) for r in got.collect())
    n = Counter(s or "" for *_, s in rows)
    w = {s: weights.get(s, 0.05) for s in n}
    want = Counter()
    for i, t, _, s in rows:
        ident = hashlib.md5(f"{'' if i is None else i}|{t or ''}".encode()).hexdigest()
        want[i, t, s] += draw(w[s or ""] / sum(w.values()) * len(rows) / n[s or ""], ident, "t")
    assert counts == +want
    by = Counter(s for (_, _, s), k in counts.items() for _ in range(k))
    assert abs(by["big"] - by["small"]) < 0.15 * by["big"]
    assert by["one"] > 50  # a rate above MAX_RATE


def test_empty_table(spark):
    assert mixing.mix_sources(documents(spark, [])).collect() == []
