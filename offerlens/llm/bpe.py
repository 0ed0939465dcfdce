"""Byte-level BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

The text is read in blocks. A block is cut into pieces (the vocabulary's pre-tokenisation); a piece is
final once three more characters were seen, because no alternative of the pattern looks further beyond
its end. Inside a piece tokens are emitted as soon as they are stable:

* ``reach``, computed from the merge list, is the length of its longest token. BPE is prefix-closed: dropping
  the last token of a tokenisation leaves the tokenisation of the remaining text. So whatever
  follows position n, the final tokenisation passes through the tokenisation of one of the prefixes that
  end in the last ``reach`` positions up to n.
* The transducer keeps, for each such prefix, only its last token. The tokens before the common ancestor of
  all of them are stable and leave; what is kept is bounded by the merge list's lookahead and not by
  the piece.
* A piece of at most ``reach`` bytes lies within the lookahead and is merged at once.

The last token of a prefix is the one token that ends there and whose pair with the token before it stays
apart under the merges. A table of pieces already seen saves most of this work; it is emptied when full.

Decoding turns ids into bytes and bytes into text with an incremental UTF-8 automaton, chunk by chunk.

A null or empty text gives no ids and the empty string; the special token's string in a text is its id, as
the vocabulary's own library has it. Rows are independent: repeated rows repeat, an empty table stays empty.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.llm import common as c

#: Fixed: the published pre-tokenisation pattern of byte-level BPE.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PIECE_LOOKAHEAD = 3
BLOCK_CHARS = 1 << 16
KNOWN_PIECES = 400_000
DECODE_IDS = 1 << 15
ID_BITS = 32
NO_RANK = 1 << 62


def byte_characters() -> dict[str, int]:
    """The published map between printable characters and bytes: others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, definition: str):
        spec = json.loads(definition)
        to_byte = byte_characters()
        as_bytes = lambda s: bytes(to_byte[x] for x in s)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.id_of = {as_bytes(s): i for s, i in spec["model"]["vocab"].items()}
        size = max([*self.id_of.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for b, i in self.id_of.items():
            self.bytes_of[i] = b
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        # one number per pair, the rank above the id that the pair becomes
        self.rank = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            left, right = map(as_bytes, pair if isinstance(pair, list) else pair.split(" "))
            self.rank.setdefault((self.id_of[left], self.id_of[right]), k << ID_BITS | self.id_of[left + right])
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.reach = max(len(b) for b in self.id_of)
        self.tails = {b[k:] for b in self.id_of for k in range(len(b))}
        self.apart: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Apply the merges in order of their rank, leftmost first; only the pairs beside a merge are looked up again."""
        ids, get = [self.byte_id[b] for b in piece], self.rank.get
        ranks = [get(pair, NO_RANK) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NO_RANK:
            k = ranks.index(best)
            ids[k] = best & (1 << ID_BITS) - 1
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), NO_RANK)
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), NO_RANK)
        return ids

    def stay_apart(self, left: int, right: int) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) > KNOWN_PIECES:
                self.apart.clear()
            known = self.apart[left, right] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def stream(self, chunks: Iterator[bytes]) -> Iterator[list[int]]:
        """Token ids of one piece that arrives in chunks, emitted once stable."""
        window, done = bytearray(), 0  # bytes after the last emitted token; their start in the piece
        last = {0: -1}  # position -> last token of the prefix that ends there
        end = 0

        def emit(to: int) -> list[int]:
            nonlocal done
            out, at = [], to
            while at > done:
                out.append(last[at])
                at -= len(self.bytes_of[last[at]])
            for p in [p for p in last if p < to]:
                del last[p]
            last[to] = out[0] if out else last[to]
            del window[: to - done]
            done = to
            return out[::-1]

        for chunk in chunks:
            for b in chunk:
                window.append(b)
                end += 1
                for size in range(1, min(self.reach, end - done) + 1):
                    tail = bytes(window[end - done - size:])
                    if tail not in self.tails:
                        break
                    token, before = self.id_of.get(tail), last.get(end - size)
                    if token is not None and before is not None and (before < 0 or self.stay_apart(before, token)) and (size == 1 or self.merge(tail) == [token]):
                        last[end] = token
                        break
                if end % self.reach == 0 and end - done > 2 * self.reach:
                    open_ends = {p for p in range(end - self.reach + 1, end + 1) if p in last}
                    while len(open_ends) > 1:
                        p = max(open_ends)
                        open_ends.remove(p)
                        open_ends.add(p - len(self.bytes_of[last[p]]))
                    if (to := open_ends.pop()) > done:
                        yield emit(to)
        if end > done:
            yield emit(end)

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode()
        if len(data) <= self.reach:
            return self.merge(data)
        blocks = (data[k: k + BLOCK_CHARS] for k in range(0, len(data), BLOCK_CHARS))
        return [i for ids in self.stream(blocks) for i in ids]


def blocks_of_pieces(text: str, block: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """The pieces of a text, block by block; pieces that more text could change wait for the next block."""
    at, size = 0, block
    while at < len(text):
        stop = at + size
        if stop >= len(text):
            yield PIECE.findall(text, at)
            return
        pieces = PIECE.findall(text, at, stop)
        end = stop
        while pieces and end > stop - PIECE_LOOKAHEAD:
            end -= len(pieces.pop())
        if pieces:
            # white space before more white space or a word splits one character earlier or later
            yield pieces
            at, size = end, block
        else:
            size *= 2


class Encoder(dict):
    """Pieces already seen, as the bytes of their ids."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.kind = np.uint16 if len(vocabulary.bytes_of) <= 1 << 16 else np.uint32
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.vocabulary.encode_piece(piece), self.kind).tobytes()
        if len(piece) <= 64:
            if len(self) >= KNOWN_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """Ids of the text, in blocks."""
        parts = [text]
        if self.split is not None and any(s in text for s in self.vocabulary.special):
            parts = self.split.split(text)
        for part in parts:
            if part in self.vocabulary.special:
                yield np.array([self.vocabulary.special[part]], self.kind)
            else:
                for pieces in blocks_of_pieces(part):
                    yield np.frombuffer(b"".join(map(self.__getitem__, pieces)), self.kind)


def decode(vocabulary: Vocabulary, blocks: Iterator[np.ndarray]) -> Iterator[str]:
    """Text of the ids: bytes that do not end a character wait for the next ids."""
    automaton = codecs.getincrementaldecoder("utf-8")("replace")
    token = vocabulary.bytes_of.__getitem__
    for ids in blocks:
        for k in range(0, len(ids), DECODE_IDS):
            yield automaton.decode(b"".join(map(token, ids[k: k + DECODE_IDS].tolist())))
    yield automaton.decode(b"", True)


def encoder_key(definition: str) -> str:
    return f"bpe {hashlib.sha256(definition.encode()).hexdigest()}"


def encoder_of(definition: str) -> Encoder:
    """One encoder per worker process and vocabulary, so that later tasks know earlier pieces; it goes when the process does other work."""
    return c.kept(encoder_key(definition), lambda: Encoder(Vocabulary(definition)))


def round_trip(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_chars of the decoded text, for each document.

    The vocabulary file is read on the driver and broadcast: its size is fixed.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        definition = f.read()
    shared, key = docs.sparkSession.sparkContext.broadcast(definition), encoder_key(definition)

    def run(batches):
        encoder = encoder_of(shared.value)
        vocabulary = encoder.vocabulary
        decimal = [b"%d" % i for i in range(len(vocabulary.bytes_of))].__getitem__
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                ids_hash, text_hash, n, chars = hashlib.sha256(), hashlib.sha256(), 0, 0

                def tokens(text=text.as_py() or ""):
                    nonlocal n
                    for ids in encoder.encode(text):
                        if len(ids):
                            ids_hash.update((b"," if n else b"") + b",".join(map(decimal, ids.tolist())))
                            n += len(ids)
                        yield ids

                for part in decode(vocabulary, tokens()):
                    text_hash.update(part.encode())
                    chars += len(part)
                rows.append((n, ids_hash.hexdigest(), text_hash.hexdigest(), chars))
            n, ids, texts, chars = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(chars, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars"])

    return c.map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                         "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long", keep=key)
