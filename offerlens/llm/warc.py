"""WARC archives as a table of payload chunks.

A payload is streamed as rows (record, chunk number, bytes of at most ``CHUNK_CHARS`` characters) that carry
the running SHA-1 of the payload so far; no step holds a record's archive form in memory. Each chunk becomes a
WARC record of its own by the standard's segmentation: the first is the response, the others are
continuations that name it, and the last holds the total length and the payload digest. Of equal payloads
of at least ``MIN_BYTES`` bytes only one is stored; the others are revisit records that refer to it.

Archives are written by Spark's text writer with the record end as its line separator, gzipped, and read as
streams of pieces between such separators; Content-Length alone decides what belongs to a payload, so
payloads may hold separators, end in a part of one, or look like records.

A null or empty payload is a response of no bytes. Among rows of equal payload and equal largest id the
first by row number is the response. A null id is stored as an empty id and counts below all others.
An empty table gives an empty archive. Other columns than the three named are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm import common as c

CHUNK_CHARS = 1 << 18
MIN_BYTES = 1000
END = "\r\n\r\n"
CRLF = b"\r\n"
CHUNKS = "row long, page_id long, url string, chunk int, last boolean, sha1 string, total long, piece string"


def _chunks(batches):
    """Chunk rows of each payload, with the digest and length of all bytes up to the chunk's end."""
    for batch in batches:
        out = []
        size = 0
        for row, page, url, html in zip(*(batch.column(k) for k in ("row", "page_id", "url", "html"))):
            text = html.as_py() or ""
            digest, total = hashlib.sha1(), 0
            for at in range(0, max(1, len(text)), CHUNK_CHARS):
                piece = text[at: at + CHUNK_CHARS]
                part = piece.encode()
                digest.update(part)
                total += len(part)
                out.append((row.as_py(), page.as_py(), url.as_py(), at // CHUNK_CHARS, at + CHUNK_CHARS >= len(text), digest.copy().hexdigest(), total, piece))
                size += len(part)
                if size > 4 << 20:
                    yield _batch(out)
                    out, size = [], 0
        if out:
            yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.string())
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)


def chunk_table(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(payload).cast("string").alias("html"))
    return c.map_batches(picked.withColumn("row", F.monotonically_increasing_id()), _chunks, CHUNKS)


def _name(page, row) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}/{row}')}>"


def _records(batches):
    """The text of one WARC record for each chunk to be stored."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            name, size = _name(r["page_id"], r["row"]), len(r["piece"].encode())
            head = ["WARC/1.1", f"WARC-Target-URI: {' '.join((r['url'] or '').split())}", "WARC-Date: 2024-01-01T00:00:00Z", f"X-Page-Id: {'' if r['page_id'] is None else r['page_id']}"]
            if r["first_row"] is not None:
                head += ["WARC-Type: revisit", f"WARC-Record-ID: {name}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                         f"WARC-Refers-To: {_name(r['first_page'], r['first_row'])}", f"X-Refers-To-Page: {'' if r['first_page'] is None else r['first_page']}",
                         f"WARC-Payload-Digest: sha1:{r['sha1']}", f"X-Payload-Bytes: {r['total']}", "Content-Length: 0"]
                out.append("\r\n".join(head) + END)
                continue
            if r["chunk"] == 0:
                head += ["WARC-Type: response", f"WARC-Record-ID: {name}"]
            else:
                head += ["WARC-Type: continuation", f"WARC-Record-ID: {_name(r['page_id'], str(r['row']) + '/' + str(r['chunk']))}", f"WARC-Segment-Origin-ID: {name}"]
            if r["chunk"] or not r["last"]:
                head.append(f"WARC-Segment-Number: {r['chunk'] + 1}")
                if r["last"]:
                    head.append(f"WARC-Segment-Total-Length: {r['total']}")
            if r["last"]:
                head.append(f"WARC-Payload-Digest: sha1:{r['sha1']}")
            out.append("\r\n".join([*head, f"Content-Length: {size}"]) + END + r["piece"])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write the pages as gzipped WARC files below ``path``.

    Which record of equal payloads is stored comes from one aggregate over (digest, length).
    """
    chunks = c.written(chunk_table(pages))
    ends = chunks.filter("last").select("row", "page_id", "sha1", "total")
    best = ends.filter(F.col("total") >= min_bytes).groupBy("sha1", "total").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("order"), (-F.col("row")).alias("row"), "page_id")).alias("best"), F.count("*").alias("n"))
    best = best.filter("n > 1").select("sha1", "total", F.col("best.page_id").alias("first_page"), (-F.col("best.row")).alias("first_row"))
    again = ends.join(best, ["sha1", "total"]).filter("row != first_row").select("row", "first_page", "first_row")
    stored = chunks.join(again, "row", "left").filter("first_row IS NULL OR last")
    stored = stored.withColumn("piece", F.when(F.col("first_row").isNull(), F.col("piece")).otherwise(""))
    c.map_batches(stored.sortWithinPartitions("row", "chunk"), _records, "value string").write.option(
        "lineSep", END).option("compression", "gzip").text(path)


def _fields(head: str) -> dict[str, str]:
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.split("\r\n")[1:])


def _parse(batches):
    """Records of one archive: header pieces, then payload pieces up to Content-Length.

    The reader splits at the first match: a payload that ends in CRLF (after whole separators) loses it to
    the separator, whose own last CRLF then leads the next piece.
    """
    out, head, need, digest, parts, shifted = [], None, 0, None, 0, False
    whole, chain = None, ("", 0)  # the digest over the segments of one record, its first record's id and the last segment's number

    def took(data: bytes) -> None:
        digest.update(data)
        if whole is not None:
            whole.update(data)

    def ended() -> None:
        """Note the record just read; a digest over segments replaces that of its header once it is proved equal."""
        if whole is not None and "WARC-Segment-Total-Length" in head:
            if f"sha1:{whole.hexdigest()}" != head.get("WARC-Payload-Digest"):
                raise ValueError(f"the segments of {chain[0]} do not have the digest of their last header")
            head["WARC-Payload-Digest"] = f"sha1:{whole.hexdigest()}"
        out.append((head, parts, digest.hexdigest()))

    for batch in batches:
        for value in batch.column("value"):
            piece = value.as_buffer().to_pybytes() if value.is_valid else b""
            if shifted:
                if not piece.startswith(CRLF):
                    raise ValueError("a record is shorter than its Content-Length")
                piece, shifted = piece[len(CRLF):], False
                if not piece:  # the end of a file
                    continue
            if head is None:
                if not piece.startswith(b"WARC/"):
                    raise ValueError(f"no WARC record: {piece[:60]!r}")
                head, digest, parts = _fields(piece.decode()), hashlib.sha1(), 0
                need = int(head["Content-Length"])
                number = int(head.get("WARC-Segment-Number", 0))
                if number == 1:
                    whole, chain = hashlib.sha1(), (head["WARC-Record-ID"], 1)
                elif number:
                    if chain != (head.get("WARC-Segment-Origin-ID"), number - 1):
                        raise ValueError(f"segment {number} of {head.get('WARC-Segment-Origin-ID')} is out of place")
                    chain = chain[0], number
                else:
                    whole, chain = None, ("", 0)
                fresh = True
                if need:
                    continue
                # a record without a payload: its end follows the header at once
                ended()
                head = "ended"
                continue
            if head == "ended":
                if piece:
                    raise ValueError("a record without payload does not end")
                head = None
                continue
            if not fresh:
                took(END.encode())
                parts += len(END)
            fresh = False
            took(piece)
            parts += len(piece)
            if need - parts == len(CRLF):
                took(CRLF)
                parts, shifted = need, True
            if parts == need:
                ended()
                head = None
            elif parts > need:
                raise ValueError("a record is longer than its Content-Length")
        if len(out) >= 4096:
            yield _parsed(out)
            out = []
    if head not in (None, "ended") or shifted:
        raise ValueError("the archive ends inside a record")
    if out:
        yield _parsed(out)


PARSED = "record string, origin string, type string, segment int, page_id long, block_bytes long, block_sha1 string, payload_digest string, payload_bytes long, refers_page long, total_length long"


def _parsed(rows: list[tuple]) -> pa.RecordBatch:
    whole = lambda x: int(x) if x else None
    data = {
        "record": [h["WARC-Record-ID"] for h, _, _ in rows], "origin": [h.get("WARC-Segment-Origin-ID") for h, _, _ in rows],
        "type": [h["WARC-Type"] for h, _, _ in rows], "segment": pa.array([int(h.get("WARC-Segment-Number", 1)) for h, _, _ in rows], pa.int32()),
        "page_id": pa.array([whole(h.get("X-Page-Id")) for h, _, _ in rows], pa.int64()), "block_bytes": pa.array([n for _, n, _ in rows], pa.int64()),
        "block_sha1": [d for _, _, d in rows], "payload_digest": pa.array([h["WARC-Payload-Digest"][5:] if "WARC-Payload-Digest" in h else None for h, _, _ in rows], pa.string()),
        "payload_bytes": pa.array([whole(h.get("X-Payload-Bytes")) for h, _, _ in rows], pa.int64()),
        "refers_page": pa.array([whole(h.get("X-Refers-To-Page")) for h, _, _ in rows], pa.int64()), "total_length": pa.array([whole(h.get("WARC-Segment-Total-Length")) for h, _, _ in rows], pa.int64()),
    }
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v, pa.string()) for k, v in data.items()})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every WARC record of the archives; gzip keeps a file in one task, which streams it."""
    pieces = spark.read.schema("value string").option("lineSep", END).text(path)
    return c.map_batches(pieces, _parse, PARSED)


def page_records(records: DataFrame) -> DataFrame:
    """One row per page: its segments are put together by their origin.

    The payload digest of a response is that of its bytes as read: of the block, or over all segments, which the reader
    took in order and checked against the last one's header.
    """
    one = F.col("origin").isNull() & F.col("total_length").isNull() & F.col("payload_digest").isNotNull()
    simple = records.filter(one).select(
        "page_id", F.coalesce("payload_bytes", "block_bytes").alias("payload_bytes"),
        F.when(F.col("type") == "revisit", F.col("payload_digest")).otherwise(F.col("block_sha1")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_page").alias("refers_to"))
    long = records.filter(~one).groupBy(F.coalesce("origin", "record").alias("record")).agg(
        F.max("page_id").alias("page_id"), F.sum("block_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"), F.max("total_length").alias("total"))
    long = long.select("page_id", F.when(F.col("payload_bytes") == F.col("total"), F.col("payload_bytes")).alias("payload_bytes"), "payload_digest",
                       F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return simple.unionByName(long)
