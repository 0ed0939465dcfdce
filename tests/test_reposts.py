import random
import time
from collections import Counter

from pyspark.sql import functions as F

import registry.reposts as queries
from offerlens import session
from offerlens.functions.text import tokens_or_empty, trim_space
from offerlens.operators import reposts


def test_copies_are_one_text_and_pairs_meet_in_cells(spark, monkeypatch):
    monkeypatch.setattr(reposts, "CELL", 2)
    monkeypatch.setattr(reposts, "BROADCAST_IDS", 0)
    pick = random.Random(5)
    base = [[f"w{pick.randrange(60)}" for _ in range(30)] for _ in range(3)]
    texts = [" ".join(w if pick.random() > 0.04 else "other" for w in pick.choice(base)) for _ in range(24)]
    texts += [texts[0]] * 30 + [". .", "-"] + ["the " * 33_000] * 2
    rows = [("a", i, f"title {i}", text, None) for i, text in enumerate(texts)]
    offers = reposts.materialized(reposts.with_repost_keys(spark.createDataFrame(rows, "company_id string, offer_id long, title string, description string, seen_at string")))
    made = reposts.distinct_texts(offers, reposts.common_tokens(offers))
    ids = {r.offer_id: r.text_id for r in made.members.collect()}
    assert [ids[i] for i in range(24, 54)] == [ids[0]] * 30 and ids[55] == 54 and ids[57] == 56
    assert made.prefixes.count() == len(set(ids.values()))
    got = {(r.left_id, r.right_id): r.similarity for r in reposts.similar_pairs(made, made, F.col("left_id") < F.col("right_id")).collect()}
    bags = {i: Counter(texts[i].replace(".", " ").replace("-", " ").split() or [""]) for i in set(ids.values())}
    want = {}
    for a in bags:
        for b in bags:
            similarity = (bags[a] & bags[b]).total() / max(bags[a].total(), bags[b].total())
            if a < b and similarity >= 0.9:
                want[a, b] = similarity
    assert got == want and len(want) > 20


def made_texts(spark, texts):
    rows = [("a", i, f"title {i}", text, None) for i, text in enumerate(texts)]
    offers = reposts.materialized(reposts.with_repost_keys(spark.createDataFrame(rows, "company_id string, offer_id long, title string, description string, seen_at string")))
    return reposts.distinct_texts(offers, reposts.common_tokens(offers))


def test_short_and_long_texts_meet_and_unlike_ones_are_not_paired(spark, monkeypatch):
    asked, possible = [], reposts._possible
    monkeypatch.setattr(reposts, "_possible", lambda pairs, *rest: asked.append(pairs.count()) or possible(pairs, *rest))
    pick = random.Random(9)
    likes = []
    for n in (1, 2, 3, 9, 10, 11, 19, 20, 40):
        words = [f"s{n}x{k}" for k in range(n)]
        likes += [words, words[1:] + [f"other{n}"], [*words, f"more{n}"], [*words, words[0]]]
    # pairs that share a rare word and nothing else
    unlike = [[f"rare{i}"] + [f"u{i}v{k}" for k in range(9)] + [f"rare{j}" for j in range(i)] for i in range(12)]
    texts = [" ".join(pick.sample(words, len(words))) for words in likes + unlike]
    made = made_texts(spark, texts)
    got = {(r.left_id, r.right_id): r.similarity for r in reposts.similar_pairs(made, made, F.col("left_id") < F.col("right_id")).collect()}
    bags = {i: Counter(t.split()) for i, t in enumerate(texts)}
    near = {(a, b): (bags[a] & bags[b]).total() / max(bags[a].total(), bags[b].total()) for a in bags for b in bags if a < b}
    assert got == {pair: x for pair, x in near.items() if x >= 0.9} and len(got) > 15
    held = [(["x%d" % i] + ["y%d_%d" % (i, k) for k in range(20)] + ["common rare"]) for i in range(30)]
    apart = made_texts(spark, [" ".join(words) for words in held])
    asked.clear()
    assert reposts.similar_pairs(apart, apart, F.col("left_id") < F.col("right_id")).isEmpty() and asked == [0]


def test_shuffle_files_go_once_a_table_is_written(spark, monkeypatch):
    monkeypatch.setattr(session, "RELEASE_S", 0.0)
    monkeypatch.setattr(session, "_released", 0.0)
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    for k in range(5):
        table = session.materialized(spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
        assert table.count() == 7
    session.release(spark, 0)
    until = time.time() + 20
    while held() > 2 and time.time() < until:
        time.sleep(0.2)
    assert held() <= 2
    assert not session.release(spark, 1000)


def test_keys_of_whole_texts_are_those_of_the_column_expressions(spark):
    every = "".join(chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000)
    odd = [None, "", " \n\t\x0b\u2003\ufeff", "-", "\x1c\x1d\x1e\x1f\x85 a\x1cb", "ΟΔΟΣ Σ İ ẞ ǅ 😀", every, *[every[k: k + 40] for k in range(0, 3000, 37)],
           "U.S. u k U, u", "EEUU and latinoamérica", "10$ a£b€ $ u€ s", "x" * 600_000, "Zz zz " * 70_000, "b a b"]
    rows = [("a", i, odd[(i * 7) % len(odd)], text, None) for i, text in enumerate(odd)]
    offers = spark.createDataFrame(rows, "company_id string, offer_id long, title string, description string, seen_at string")
    t, d = tokens_or_empty(F.col("title")), tokens_or_empty(F.col("description"))
    joined = lambda c: F.array_join(c, "\n")
    want = offers.select(
        "offer_id", (F.coalesce(trim_space(F.col("title")) != "", F.lit(False))).alias("has_title"), (F.coalesce(trim_space(F.col("description")) != "", F.lit(False))).alias("has_description"),
        F.sha2(joined(t), 256).alias("title_key"), F.when((F.size(t) > 0) & (F.size(d) > 0), F.sha2(F.concat(joined(t), F.lit("\n\n"), joined(d)), 256)).alias("fingerprint"),
        F.array_join(F.sort_array(d), " ").alias("words"))
    got = reposts.with_repost_keys(offers)
    assert "description_tokens" not in got.columns
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect(), key=lambda r: r.offer_id)


def test_texts_of_other_lengths_are_not_paired(spark):
    # 60 texts of six lengths hold "rare" among their rarest elements: 1770 pairs, if their lengths did not count
    texts = [" ".join(["rare"] * 3 + [f"w{k}" for k in range(3 * 2 ** (i % 6))]) for i in range(60)]
    made = made_texts(spark, [f"{t} t{i}" for i, t in enumerate(texts)])
    held, asked = reposts._keys(made.prefixes, "left", reposts._length("n")), reposts._keys(made.prefixes, "right", F.explode(reposts._lengths("n", 0.9)))
    met = held.join(asked, ["key", "company_id"]).filter("left_id < right_id")
    assert all(m <= 6 * 45 for m in (r["count"] for r in met.groupBy("key").count().collect()))
    assert reposts.estimated_pairs(made.prefixes, 0.9) >= met.count() > 0
    lengths = spark.range(1, 3000).select(F.col("id").alias("n"), reposts._length("id").alias("own"), reposts._lengths("id", 0.9).alias("asked")).collect()
    own = {r.n: r.own for r in lengths}
    for r in lengths:
        assert {own[m] for m in range(1, 3000) if min(m, r.n) >= max(m, r.n) * 0.9 - 1e-9} <= set(r.asked) and len(r.asked) <= 3


def test_duplicates_read_the_texts_once(spark):
    for name in (queries.d5, queries.d6):
        read = name(spark, "/root/testdata/sf0.001").inputFiles()
        assert read and not any("documents" in f for f in read)
