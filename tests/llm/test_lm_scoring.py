import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from offerlens.llm import lm_scoring, ppm
from tests.llm.helpers import ODD_TEXTS, documents, prose, words


def symbols(text):
    return [ppm.STOP] * ppm.ORDER + list(" ".join(words(text)).encode()) + [ppm.STOP]


class SlowTrie:
    """The same code by its definition, one symbol at a time."""

    def __init__(self, texts, rare):
        count = defaultdict(Counter)
        total = 0
        for t in texts:
            s = symbols(t)
            for i in range(ppm.ORDER, len(s)):
                total += 1
                for k in range(ppm.ORDER + 1):
                    count[tuple(s[i - k:i])][s[i]] += 1
        least = max(1, total / rare)
        full = {x: sum(n.values()) for x, n in count.items()}
        self.kept = {x: {a: n for a, n in nx.items() if n >= least} for x, nx in count.items()}
        self.kept = {x: nx for x, nx in self.kept.items() if nx}
        self.full = {}
        for x, nx in self.kept.items():
            # occurrences of the context, which may also stand before the end of a text
            occurs = count[x[:-1]][x[-1]] if x else full[x]
            self.full[x] = max(occurs, sum(nx.values()))

    def log10(self, context, symbol):
        k = max((k for k in range(ppm.ORDER + 1) if context[len(context) - k:] in self.kept), default=-1)
        p, excluded = 1.0, set()
        while k >= 0:
            x = context[len(context) - k:]
            left = {a: n for a, n in self.kept[x].items() if a not in excluded}
            escape = self.full[x] - sum(self.kept[x].values()) + len(left) / 2
            if left:
                if symbol in left:
                    return math.log10(p * left[symbol] / (sum(left.values()) + escape))
                p *= escape / (sum(left.values()) + escape)
            excluded = set(self.kept[x])
            k -= 1
        return math.log10(p / (256 - len(excluded)))

    def score(self, text):
        s = symbols(text)
        return sum(self.log10(tuple(s[i - ppm.ORDER:i]), s[i]) for i in range(ppm.ORDER, len(s)))


def training(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 != 0


@pytest.mark.parametrize("rare,frequent", [(1 << 22, 1 << 17), (600, 30)])
def test_against_brute_force(spark, monkeypatch, rare, frequent):
    monkeypatch.setattr(ppm, "RARE", rare)
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(0, 40), 60).title(), "en", "a") for i in range(150)]
    odd = [t if t is None or len(t) < 3000 else t[:3000] for t in ODD_TEXTS]
    rows += [(1000 + k, t, None, None) for k, t in enumerate(odd)] + [rows[3]] * 3 + [(None, "no id", None, None)]
    got = lm_scoring.score_documents(documents(spark, rows)).collect()
    train = [t for i, t, *_ in rows if training(i)]
    c = Counter(w for t in train for w in [*words(t), "\n"])
    n, v = sum(c.values()), len(c)
    slow = SlowTrie(train, rare)
    want = []
    for i, t, *_ in rows:
        tokens = [*words(t), "\n"]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want.append((i, not training(i), len(tokens), sum(c[w] > 0 for w in tokens), n, base, slow.score(t)))
    key = lambda r: (r[0] is not None, r[0], r[2], r[5])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_sum_to_one():
    slow = [symbols("abra cadabra abracadabra"), symbols("bar bra")]
    keys = []
    for s in slow:
        keys += [sum(s[i - k] << 8 * (ppm.ORDER - k) for k in range(ppm.ORDER + 1)) for i in range(ppm.ORDER, len(s))]
    key, count = np.unique(np.array(keys, np.uint64), return_counts=True)
    trie = ppm.Trie([ppm.shorter(key, count, k) for k in range(ppm.ORDER + 1)], int(count.sum()))
    for context in {int(k) & ((1 << 8 * ppm.ORDER) - 1) for k in keys} | {0}:
        every = (np.arange(256, dtype=np.uint64) << np.uint64(8 * ppm.ORDER)) | np.uint64(context)
        assert (10 ** trie.code_lengths(every)).sum() == pytest.approx(1, abs=1e-9)


def test_empty_tables(spark):
    assert lm_scoring.score_documents(documents(spark, [])).collect() == []
    i = next(i for i in range(100) if not training(i))
    [row] = lm_scoring.score_documents(documents(spark, [(i, "a b", None, None)])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == pytest.approx(0, abs=1e-9)
    assert row.score == pytest.approx(-4 * math.log10(256))


@pytest.mark.parametrize("shared", [1 << 21, 50])
def test_no_n_gram_is_cut_as_the_corpus_grows(spark, monkeypatch, shared):
    monkeypatch.setattr(lm_scoring, "SHARED", shared)
    assert all(max(1.0, symbols / ppm.RARE) == 1 for symbols in (10 ** 8, 3 * 10 ** 10, 10 ** 15))
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(0, 60), 500), "en", "a") for i in range(200)] + [(1000, "", None, None), (1001, "Zyx qwv", None, None)]
    got = {r.doc_id: r.score for r in lm_scoring.score_documents(documents(spark, rows)).collect()}
    slow = SlowTrie([t for i, t, *_ in rows if training(i)], math.inf)
    assert got == pytest.approx({i: slow.score(t) for i, t, *_ in rows}, rel=1e-9)


@pytest.mark.parametrize("grams,groups", [(1 << 19, 16), (200, 0)])
def test_partial_scores_follow_the_model_and_not_the_text(spark, monkeypatch, grams, groups):
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 1 << 9)
    monkeypatch.setattr(lm_scoring, "SHARED", 50)
    monkeypatch.setattr(lm_scoring, "GRAMS", grams)
    seen, groups_of, score_misses = [], lm_scoring.groups_of, lm_scoring._score_misses
    monkeypatch.setattr(lm_scoring, "groups_of", lambda tries, shards: seen.append((shards, groups_of(tries, shards))) or seen[0][1])
    made = spark.sparkContext.accumulator(0)

    def counted(low):
        def run(batches):
            for out in score_misses(low)(batches):
                made.add(out.num_rows)
                yield out
        return run

    monkeypatch.setattr(lm_scoring, "_score_misses", counted)
    rng = random.Random(10)
    rows = [(i, prose(rng, 60, 300), "en", "a") for i in range(150)]
    got = {r.doc_id: r.score for r in lm_scoring.score_documents(documents(spark, rows)).collect()}
    slow = SlowTrie([t for i, t, *_ in rows if training(i)], math.inf)
    assert got == pytest.approx({i: slow.score(t) for i, t, *_ in rows}, rel=1e-9)
    [(shards, found)] = seen
    assert shards > 40 and (found == groups if groups else found > 16)
    assert 0 < made.value <= len(rows) * found


def test_a_group_of_shards_is_scored_by_several_tasks():
    assert [lm_scoring.parts_of(*x) for x in ((16, 16), (31, 16), (1875, 16), (1875, 1875))] == [1, 2, 118, 1]
    keys = np.arange(1 << 16, dtype=np.uint64) << np.uint64(8)
    tasks = set()
    for row in range(40):
        out = lm_scoring._misses([keys], [np.full(len(keys), row)], 64, 16)
        tasks |= set(out.column("shard").to_pylist())
        assert out.num_rows <= 16
    assert tasks == set(range(64))


def test_packed_numbers():
    numbers = np.array([0, 1, 255, 256, (1 << 48) - 1], np.uint64)
    assert (ppm.unpacked(ppm.packed(numbers, 6), 6) == numbers).all() and len(ppm.unpacked(b"", 6)) == 0


def test_workers_hold_no_more_than_their_task_needs():
    rows = lambda *texts: [pa.RecordBatch.from_pydict({"text": list(texts)})]
    lm_scoring._indexes["earlier"] = ppm.Index(np.arange(9, dtype=np.uint64))
    list(lm_scoring._gathered(rows("a b", None), 4))
    assert not lm_scoring._indexes
    keys, counts = [np.array([3, 1], np.uint64), np.array([3], np.uint64)], [np.array([1, 5]), np.array([2])]
    key, count = ppm.merged(keys, counts)
    assert key.tolist() == [1, 3] and count.tolist() == [5, 3] and not keys and not counts
    assert len(ppm.Index(np.arange(1_000_000, dtype=np.uint64)).slots) == 1 << 21
