import gzip
import glob
import hashlib
import os
import random

import pytest

from offerlens.llm import common as c
from offerlens.llm import warc


def run(spark, rows):
    pages = spark.createDataFrame([(*r, "z", 3) for r in rows], "page_id long, url string, html string, row string, chunk int")
    path = c.shared_folder(spark)
    warc.write_archives(pages, path)
    return path, warc.page_records(warc.read_archives(spark, path)).collect()


def test_round_trip_with_hostile_payloads(spark, monkeypatch):
    rng = random.Random(2)
    end = "\r\n\r\n"
    texts = [None, "", "x" * 999, "x" * 1000, end, end * 400, f"WARC/1.1\r\nContent-Length: 3{end}abc{end}" * 40, "é漢\U0001f600" * 700,
             "a" + end, end + "a", "\n" * 1200, "\r\n\r" * 500, "long " * 200_000, "long " * 200_000 + end]
    rows = [(i, f"http://x/{i}\r\nInjected: y", t) for i, t in enumerate(texts)]
    rows += [(100 + i, None, rng.choice(texts)) for i in range(60)] + [(7, "u", "q" * 2000), (7, "u", "q" * 2000), (None, "u", "q" * 2000), (None, None, "z")]
    path, got = run(spark, rows)
    want = []
    best = {}
    for page, _, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if page is None else page)
    done = set()
    for page, _, t in rows:
        data = (t or "").encode()
        again = len(data) >= 1000 and (page != best[t or ""] or t in done)
        if page == best[t or ""]:
            done.add(t)
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", best[t or ""] if again else None))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    raw = b"".join(gzip.open(f).read() for f in glob.glob(path.removeprefix("file:") + "/part-*"))
    assert raw.count(b"WARC-Type: continuation") >= 6 and b"\r\nInjected" not in raw


def test_empty_table(spark):
    assert run(spark, [])[1] == []


def test_payloads_and_chunks_that_end_in_crlf(spark, monkeypatch):
    texts = ["\r\n", "abc\r\n", "abc\r\n\r\n\r\n", "\r\n" * 5, "\r\n" * 801, "line\r\n" * 300, "abc\r\n\r", "x" * (warc.CHUNK_CHARS - 2) + "\r\n" + "rest\r\n",
             "x" * (warc.CHUNK_CHARS - 6) + "\r\n" * 3 + "WARC/1.1\r\n"]
    for rows in [[(i, "u", t)] for i, t in enumerate(texts)] + [[(i, "u", t) for i, t in enumerate(texts)]]:
        got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type) for r in run(spark, rows)[1])
        assert got == [(i, len(t), hashlib.sha1(t.encode()).hexdigest(), "response") for i, _, t in rows]


def test_changed_or_displaced_segments_are_found(spark):
    text = "".join(random.Random(3).choices("abcdef ", k=3 * warc.CHUNK_CHARS))
    path, got = run(spark, [(1, "u", text), (2, "u", "short")])
    assert {r.page_id: r.payload_digest for r in got} == {1: hashlib.sha1(text.encode()).hexdigest(), 2: hashlib.sha1(b"short").hexdigest()}
    [file] = [f for f in glob.glob(path.removeprefix("file:") + "/part-*") if b"WARC-Segment-Number: 3" in gzip.open(f).read()]
    whole = gzip.open(file).read()
    pieces = [text[k * warc.CHUNK_CHARS: (k + 1) * warc.CHUNK_CHARS].encode() for k in range(3)]
    for broken in (whole.replace(pieces[1], pieces[1][::-1]), whole.replace(pieces[0], b"#").replace(pieces[1], pieces[0]).replace(b"#", pieces[1]),
                   whole.replace(b"WARC-Segment-Number: 2", b"WARC-Segment-Number: 4")):
        folder = c.shared_folder(spark)
        os.makedirs(folder)
        with gzip.open(f"{folder}/part-0.txt.gz", "wb") as out:
            out.write(broken)
        with pytest.raises(Exception, match="digest of their last header|out of place"):
            warc.page_records(warc.read_archives(spark, folder)).collect()
