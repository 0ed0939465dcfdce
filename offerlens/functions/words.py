"""Tokens of whole texts in Python workers: those of ``text.normalize_tokens``, as byte strings and as numpy hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from offerlens.constants import CURRENCY_TOKENS
from offerlens.functions.text import _fold_table

SLICE_BYTES, SLICE_ROWS = 1 << 18, 1 << 14
FEW = 32

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CODES = tuple((symbol.encode(), code.encode()) for symbol, code in CURRENCY_TOKENS)
REGIONS = {(b"u", b"s"): [b"us", b"usa"], (b"u", b"k"): [b"uk"], b"eeuu": [b"us", b"usa"], b"latinoamerica": [b"latam"]}
TRIGGERS = frozenset((b"u", b"eeuu", b"latinoamerica"))


@lru_cache(maxsize=1)
def _folds() -> tuple[bytes, dict[int, str | None]]:
    """The map of ``text._fold_table`` for ASCII bytes and for all characters."""
    source, target = _fold_table()
    every: dict[int, str | None] = {}
    for place, char in enumerate(source):
        every.setdefault(ord(char), target[place] if place < len(target) else None)
    return bytes(ord(every.get(b) or chr(b)) if b < 128 else b for b in range(256)), every


def _folded(text: str, every: dict[int, str | None]) -> str:
    """The text with its characters beyond ASCII mapped: one pass for each of them, as long as they are few."""
    found = [c for c in set(text) if c > "\x7f" and ord(c) in every]
    if len(found) > FEW or any(ord(every[ord(c)] or " ") > 127 for c in found):
        return text.translate(every)
    for c in found:
        text = text.replace(c, every[ord(c)] or "")
    return text


def tokens(lowered: bytes | None) -> list[bytes]:
    """The tokens of a text that is in lower case already."""
    if not lowered:
        return []
    ascii_, every = _folds()
    text = lowered if lowered.isascii() else _folded(lowered.decode(), every).encode()
    text = text.translate(ascii_)
    words = text.split()
    if any(symbol in text for symbol, _ in CODES):
        words = [x for word in words for x in (word, *(code for symbol, code in CODES if symbol in word))]
    if not TRIGGERS.isdisjoint(words):
        words = [x for word, after in zip(words, [*words[1:], None]) for x in (word, *REGIONS.get(word, REGIONS.get((word, after), ())))]
    return words


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``SLICE_BYTES``; a text is never cut, a null one counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n, at = len(column), 0
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        to = min(n, at + SLICE_ROWS, max(at + 1, to))
        yield at, to, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=1)
def _slice_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(SLICE_BYTES + 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    steps = [np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]) for base in (BASE, BASE_INVERSE)]
    return np.multiply.accumulate(steps[0]), np.multiply.accumulate(steps[1])


def hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, words of each row): rows of words with one space between them; an empty row is one empty word."""
    up, down = _slice_powers() if len(data) <= SLICE_BYTES else _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=sums[1:])
    spaces = np.flatnonzero(data == 32)
    start, end = np.sort(np.concatenate([offsets[:-1], spaces + 1])), np.sort(np.concatenate([offsets[1:], spaces]))
    counts = np.diff(np.searchsorted(spaces, offsets)) + 1
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)), counts


def occurrences(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The how manyth of its equals each word is; equal words of a row lie together."""
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    return np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h)))) + 1


def elements(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    """A hash of the k-th occurrence of a word."""
    return _mix(h + k.astype(np.uint64) * BASE)
