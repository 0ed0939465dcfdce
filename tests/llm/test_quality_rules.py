import random
from collections import Counter, defaultdict

import pytest

from offerlens.llm import quality_rules
from tests.llm.helpers import ODD_TEXTS, WORD, documents, prose


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), sum(x in "#*$%&|<>" for x in text or ""), len(lines) - len(set(lines)), len(covered), failed


def has_letter(word):
    return any(x.isascii() and x.isalpha() or ord(x) > 127 for x in word)


def normal(line, min_line_words=8):
    """The folded words of a line that may count, else nothing."""
    words = WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in line))
    if sum(map(has_letter, words)) < min_line_words:
        return ()
    return tuple(w if has_letter(w) else "".join("0" if "0" <= x <= "9" else x for x in w) for w in words)


def brute(rows, min_docs, share, min_words=10, min_left=0.3, min_line_words=8):
    def normal(line):
        return globals()["normal"](line, min_line_words)

    hosts, seen = defaultdict(set), defaultdict(set)
    for _, t, _, s in rows:
        hosts[s].add(t or "")
        for line in (t or "").split("\n"):
            if normal(line):
                seen[s, normal(line)].add(t or "")
    out = []
    for i, t, _, s in rows:
        *counts, failed = base(t)
        gone = sum(len(normal(x)) for x in (t or "").split("\n") if len(seen[s, normal(x)]) >= max(min_docs, share * len(hosts[s])))
        left = counts[0] - gone
        depleted = gone > 0 and (left < min_words or left < min_left * counts[0])
        out.append((i, *counts, failed, not failed and not depleted, gone))
    return out


def check(spark, rows, **limits):
    got = quality_rules.judge_lines(documents(spark, rows), **limits).drop("host", "text_hash").collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, **limits), key=key)


def test_against_brute_force(spark):
    rng = random.Random(5)
    boiler = ["Cookie notice No 12 please accept", "All rights reserved by the owner of this page 2024"]
    rows = []
    for i in range(300):
        lines = [prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:
            lines.insert(rng.randint(0, len(lines)), rng.choice(boiler).replace("12", str(rng.randint(10, 99))))
        if rng.random() < 0.1:
            lines = [rng.choice(boiler)] * 2 + ["a b c"]
        if rng.random() < 0.1:
            lines += lines
        rows.append((i, "\n".join(lines), "en", rng.choice(["a", "a", "b", None])))
    rows += [(1000 + k, t, None, "a") for k, t in enumerate(ODD_TEXTS)] + [(None, "x y", None, None), rows[3], rows[3]]
    check(spark, rows, min_docs=5, share=0.02, min_line_words=1)
    check(spark, rows, min_docs=20, share=0.05, min_line_words=6)


def test_copies_count_once_and_empty_table(spark):
    text = "\n".join(" ".join(f"word{k}x{j}" for j in range(9)) for k in range(5))
    rows = [(i, text, "en", "a") for i in range(60)]
    assert quality_rules.judge_lines(documents(spark, rows)).filter("kept").count() == 60
    assert quality_rules.judge_lines(documents(spark, [])).collect() == []


def test_rejected_documents_go_with_all_columns_kept(spark):
    rows = [(1, "too short", "en", "a"), (2, "a b c d e f g h i j k l", "en", None), (2, "no", "en", None), (None, None, None, None)]
    docs = documents(spark, rows)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert [(r.doc_id, r.text) for r in kept.collect()] == [(2, "a b c d e f g h i j k l")]


def test_common_lines_leave_the_text(spark):
    rng = random.Random(11)
    body = lambda: prose(rng, 40, 4000)
    rows = [(i, f"{body()}\nAccept  cookies é {i % 7}\n{body()}\r\n\nACCEPT COOKIES é 9", "en", "a") for i in range(30)] + [(50, "own " + body(), "en", "a"), (50, "own", "en", "b")]
    docs = documents(spark, rows)
    want = {i: t if i == 50 else t.split("\n")[0] + "\n" + t.split("\n")[2] + "\n\n" for i, t, _, s in rows if s == "a"}
    got = {r.doc_id: r for r in quality_rules.keep_good(docs, min_line_words=3).collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    spans = {r.doc_id: r.removed_spans for r in quality_rules.judge_spans(docs, min_line_words=3).filter("removed_words > 0").collect()}
    assert {i: quality_rules.without(t, [s.asDict() for s in spans.get(i, [])]) for i, t, _, s in rows if s == "a"} == want


def test_a_line_is_common_in_a_host_of_any_size(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, 30, 4000) + ("\nshared notice of the owner" if i < 25 else ""), "en", "a") for i in range(1000)]
    got = quality_rules.judge_lines(documents(spark, rows), min_line_words=5).filter("removed_words > 0").collect()
    assert sorted((r.doc_id, r.removed_words) for r in got) == [(i, 5) for i in range(25)]


SAYINGS = ["Yes.", "No.", "I do not know.", "What do you mean by that?", "Thank you, that is all for today.", "12 30 2024 17", "2024-01-02 10:30"]


@pytest.mark.parametrize("n", [20, 2_000, 20_000])
def test_dialogues_and_tables_stay_and_notices_go_in_hosts_of_any_size(spark, n):
    rng = random.Random(n)
    notice = "By using this site you accept our terms of use, version 7"
    talk = [(i, "\n".join([*rng.sample(SAYINGS, 6), f"own{i} word{i} of this one talk{i}"]), "en", "a") for i in range(n)]
    table_ = [(n + i, "\n".join(f"w{i}x{k} {k} {i % 7} 2024" for k in range(9)), "en", "a") for i in range(n)]
    noted = [(2 * n + i, f"{prose(rng, 30, 4000)}\n{notice.replace('7', str(i % 10))}", "en", "a") for i in range(25)]
    got = {r.doc_id: r for r in quality_rules.judge_lines(documents(spark, talk + table_ + noted)).collect()}
    assert all(got[i].removed_words == 0 and got[i].kept == (not got[i].base_failed) for i in range(2 * n))
    assert all(got[2 * n + i].removed_words == 12 and got[2 * n + i].kept for i in range(25))


def test_untouched_texts_meet_no_join_by_exchange(spark):
    rng = random.Random(13)
    rows = [(i, prose(rng, 40, 4000) if i % 3 else "too short", "en", "a") for i in range(300)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        good = quality_rules.keep_good(documents(spark, rows))
        stay, judged = (good._jdf.queryExecution().sparkPlan().children().apply(k).toString() for k in (0, 1))
        assert "SortMergeJoin" not in stay and "SortMergeJoin" in judged
        assert sorted(r.doc_id for r in good.collect()) == [i for i in range(300) if i % 3]
        # a bit table of all rows holds them, one of none holds none
        numbered = spark.range(1000).selectExpr("xxhash64(id) AS __row")
        held = numbered.selectExpr("__row", f"{quality_rules.SLOT} AS __slot").join(quality_rules.row_filter(numbered.limit(500)), "__slot", "left")
        assert 500 <= held.filter(f"__words[{quality_rules.WORD}] & {quality_rules.BIT} <> 0").count() < 510
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
