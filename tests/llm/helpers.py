"""Small tables and brute-force counterparts for the tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(lower(text or ""))


def documents(spark, rows):
    """(doc_id, text, lang, source) rows plus columns with names that operators use inside."""
    data = [(i, t, lang, s, None if t is None else len(t), "x", 1, True) for i, t, lang, s in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "row string, score int, kept boolean")


def prose(rng: random.Random, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}{rng.choice(['', '.', 'é'])}" for _ in range(n))


ODD_TEXTS = [None, "", " \n\t ", "one", "a b c d", "A B C D E", "x" * 50_000, "\n\n\nline\nline\n line \n", "ß ñ 漢字 \U0001f600 é",
             "tab\tand\x0bvt\x0cff\r\ncrlf", "nbsp inside  em", "# $ % & | < > *", "same words " * 3000]


def table(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
