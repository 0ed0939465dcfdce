import random

from pyspark.sql import functions as F

from offerlens.functions.text import normalize_tokens
from offerlens.operators import dictionary, matching, reposts, scoring


def test_tokens(spark):
    cases = {
        "Salary $100K": ["salary", "$100k", "usd"],
        "U.S. market": ["u", "us", "usa", "s", "market"],
        "EEUU y Latinoamérica": ["eeuu", "us", "usa", "y", "latinoamerica", "latam"],
        "10€/£5": ["10€", "eur", "£5", "gbp"],
        "": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    for row in df.select("v", normalize_tokens(F.col("v")).alias("t")).collect():
        assert row.t == cases[row.v]


def test_shipped_dictionary_scores(spark):
    d = dictionary.read_dictionary(spark)
    assert dictionary.validate_dictionary(d).count() == 0
    patterns = dictionary.compile_dictionary(d)
    offers = spark.createDataFrame(
        [(1, "Forex", "plain"), (2, "x", "sin experiencia en forex"), (3, "y", None)],
        "offer_id long, title string, description string")
    hits = matching.match_offers(offers, patterns, "offer_id")
    got = {r.offer_id: r for r in scoring.score_offers(hits, offers, "offer_id").collect()}
    assert got[1].score == 6.0 and got[1].core
    assert got[2].score == 0.0 and got[2].negated_keyword_hits == 1
    assert got[3].score == 0.0 and got[3].top_category_id == ""


def brute_fold(rows):
    """Plain sequential fold as the yardstick for small inputs."""
    from collections import Counter

    canon, out = [], {}
    for seq, company, title, text in rows:
        t, d = title.split(), text.split()
        mates = [c for c in canon if c[1] == company]
        hit = next((c[0] for c in mates if c[2] == t), None)
        if hit is None:
            best = None
            for c in mates:
                s = sum((Counter(d) & Counter(c[3])).values()) / max(len(d), len(c[3]))
                if s >= 0.9 and (best is None or s > best[0]):
                    best = (s, c[0])
            hit = best[1] if best else None
        if hit is None:
            canon.append((seq, company, t, d))
        out[seq] = hit
    return out


def fold_input(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(words) for _ in range(30)] for _ in range(4)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(30)] = rng.choice(words)
        rows.append((i, rng.choice("ab"), f"t{rng.randrange(3 * n)}", " ".join(text)))
    return rows


def check_fold(spark, max_pairs):
    rows = fold_input(60, 7)
    df = spark.createDataFrame(
        [(*r, None) for r in rows],
        "offer_id long, company_id string, title string, description string, seen_at string")
    folded = reposts.fold_reposts(df, max_pairs=max_pairs).collect()
    want = brute_fold(rows)
    assert {r.offer_id for r in folded if r.is_repost} == {k for k, x in want.items() if x is not None}


def test_fold_equals_sequential(spark):
    check_fold(spark, 1e9)


def test_fold_in_windows_equals_sequential(spark):
    check_fold(spark, 300)
