import random
from collections import defaultdict

import pytest

from offerlens.operators import directories, ordered, reposts


def brute_kept(claims):
    by = defaultdict(list)
    for item, key, holds, asks in claims:
        by[item].append((key, holds, asks))
    taken, kept = set(), []
    for item in sorted(by):
        if not any(asks and key in taken for key, _, asks in by[item]):
            kept.append(item)
            taken.update(key for key, holds, _ in by[item] if holds)
    return kept


@pytest.mark.parametrize("limit", [5, 1000])
def test_first_kept_equals_an_ordered_loop(spark, limit):
    rng = random.Random(limit)
    claims = [(i, f"k{int(rng.paretovariate(0.7)) % 150}", rng.random() < 0.7, rng.random() < 0.8) for i in range(400) for _ in range(rng.choice([1, 2, 3]))]
    df = spark.createDataFrame(claims, "item long, key string, holds boolean, asks boolean").repartition(5)
    assert sorted(r.item for r in ordered.first_kept(df, limit).collect()) == brute_kept(claims)
    assert ordered.first_kept(df.limit(0)).count() == 0


def jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    out = action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_components_of_long_paths_and_a_hub(spark):
    links = [(i, i + 1) for i in range(3000)] + [(10_000 + i, 9_999) for i in range(2000)] + [(50_000, 50_000)]
    random.Random(1).shuffle(links)
    got = dict(map(tuple, ordered.components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()))
    assert set(got.values()) == {0, 9_999, 50_000} and len(got) == 3001 + 2001 + 1 and got[2999] == 0 and got[11_999] == 9_999


def test_first_wins_of_a_long_chain_takes_few_jobs(spark):
    chain = [("s", i, f"d{i // 2}", f"n{(i + 1) // 2}") for i in range(1000)]
    df = spark.createDataFrame(chain, "source string, seq long, domain string, name string")
    short, few = jobs(spark, "short", lambda: directories.first_wins(df.filter("seq < 10")).collect())
    long, many = jobs(spark, "long", lambda: directories.first_wins(df).collect())
    assert sorted(r.seq for r in long) == list(range(0, 1000, 2)) and len(short) == 5
    assert many <= few + 20


def brute_choices(asks, events):
    value = {}
    marks = sorted([(i, 0, o, v) for i, o, v in events if v is not None] + [(i, 1, None, None) for i in {a[0] for a in asks}], key=lambda m: (m[0], -m[1]))
    options, start = defaultdict(list), {}
    own = {}
    for i, o, s, v in asks:
        options[i].append(o)
        start[(i, o)] = s
        own[i] = v
    out = {}
    for i, ask, o, v in marks:
        if not ask:
            value[o] = v
            continue
        def rank(o, i=i):
            now = value.get(o, start[(i, o)])
            return (now is not None, now or "", -o)
        out[i] = max(options[i], key=rank)
        if own[i] is not None:
            value[out[i]] = own[i]
    return out


@pytest.mark.parametrize("limit", [7, 1000])
def test_choices_equal_an_ordered_loop(spark, monkeypatch, limit):
    monkeypatch.setattr(ordered, "BLOCK", 16)
    rng = random.Random(limit)
    start = {o: rng.choice([None, "2020", "2021"]) for o in range(30)}
    asks, events = [], []
    for i in range(100, 300):
        if rng.random() < 0.6:
            value = rng.choice([None, f"20{rng.randrange(20, 30)}"])
            asks += [(i, o, start[o], value) for o in rng.sample(range(30), rng.choice([2, 3]))]
        else:
            events.append((i, rng.randrange(30), rng.choice([None, f"20{rng.randrange(20, 30)}"])))
    got = ordered.ordered_choices(spark.createDataFrame(asks, "item long, option long, start string, value string"),
                                  spark.createDataFrame(events, "item long, option long, value string"), limit)
    assert dict(map(tuple, got.collect())) == brute_choices(asks, events)


def drifting(n):
    """Each text differs from the one before in one of twenty words: neighbours are similar, others are not."""
    words = [f"w{k}" for k in range(20)]
    for i in range(n):
        words[(2 * i) % 20] = f"a{i}"
        yield (1, i, f"title {i}", " ".join(words), "2024-01-01")


def test_a_chain_of_drifting_copies(spark):
    schema = "company_id long, offer_id long, title string, description string, seen_at string"
    rows = list(drifting(200))
    short, few = jobs(spark, "few", lambda: reposts.fold_reposts(spark.createDataFrame(rows[:20], schema)).collect())
    long, many = jobs(spark, "many", lambda: reposts.fold_reposts(spark.createDataFrame(rows, schema)).collect())
    kept = sorted(r.offer_id for r in long if not r.is_repost)
    bags = {i: set(d.split()) for _, i, _, d, _ in rows}
    want = []
    for i in range(200):
        if not any(len(bags[i] & bags[k]) >= 18 for k in want[-3:]):
            want.append(i)
    assert kept == want and len(kept) < 160 and many <= few + 25


def test_many_tied_reposts(spark):
    schema = "company_id long, offer_id long, title string, description string, seen_at string"
    shared = [f"w{k}" for k in range(35)]
    rows = [(1, k, f"first {k}", " ".join(shared + [f"{own}{n}" for n in range(5)]), f"2024-01-0{k + 1}") for k, own in enumerate("ab")]
    tied = " ".join(shared + ["a1", "b1", "c1", "c2", "c3"])
    rows += [(1, 2 + i, f"t{i}", tied, f"2024-02-{1 + i % 28:02d}") for i in range(200)]
    got, _ = jobs(spark, "tied", lambda: {r.offer_id: r for r in reposts.fold_reposts(spark.createDataFrame(rows, schema)).collect()})
    seen = {0: "2024-01-01", 1: "2024-01-02"}
    assert not got[0].is_repost and not got[1].is_repost
    for i in range(200):
        best = max(seen, key=lambda o: (seen[o], -o))
        assert got[2 + i].canonical_id == best
        seen[best] = rows[2 + i][4]
