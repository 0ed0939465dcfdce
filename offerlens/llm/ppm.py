"""Prediction by partial matching over bytes: the trie of contexts and its code lengths, in numpy.

A text is its words, lower-cased (A-Z), one space between them and an end symbol. An n-gram is a number whose top
byte is the symbol and whose next bytes are the context, nearest byte first: dropping the low byte drops
the farthest context byte, so in sorted order every shorter n-gram is a run and one sort counts all orders.

The trie holds every n-gram of the training texts, whatever their size. A finite ``RARE`` is a limit that a caller may
set: n-grams of less than ``1 / RARE`` of the training bytes go, and a context's continuations that are not
in the trie are part of its escape estimate, so the code stays a probability distribution.

A trie can be cut into shards by the ``NEAR`` nearest context bytes: the lower orders are in all of them, and all
n-grams that follow or shorten a context down to ``NEAR`` bytes are in its shard.

Coding a symbol starts at the longest known context. A context codes its symbols by their counts; its escape weight is
the count of what the trie does not hold plus half a count for each symbol it holds. After an escape the
symbols of the longer context are excluded from the shorter one. Below the empty context all 256 values left
are alike.
"""

from __future__ import annotations

import numpy as np

from offerlens.llm import common as c

ORDER = 5
NEAR = 3
RARE = float("inf")
STOP = 10


def canonical(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows, ORDER stop bytes before each row, and the row of each symbol (-1: padding)."""
    count = np.bincount(row, minlength=n)
    size = end - start + 1
    length = np.maximum(np.bincount(row, size, n).astype(np.int64), 1)
    begin = np.cumsum(length + ORDER) - length  # first symbol of each row
    out = np.full(int(begin[-1] + length[-1]) if n else 0, STOP, np.uint8)
    owner = np.repeat(np.arange(n), length + ORDER)
    pad = np.concatenate([[0], np.cumsum(length + ORDER)])[:-1]
    owner[(pad[:, None] + np.arange(ORDER)).ravel()] = -1
    if len(start):
        before = np.concatenate([[0], np.cumsum(size)])[:-1]
        first_of_row = np.concatenate([[0], np.cumsum(count)])[:-1]
        at = begin[row] + before - before[np.minimum(first_of_row, len(start) - 1)][row]
        flat = np.arange(int(size.sum())) - np.repeat(before, size)
        source = np.repeat(start, size) + flat
        target = np.repeat(at, size) + flat
        last = flat == np.repeat(size - 1, size)
        out[target[~last]] = c.LOWER[data[source[~last]]]
        gaps = at + size - 1
        final = np.zeros(len(start), bool)
        final[:-1] = row[:-1] != row[1:]
        final[-1] = True
        out[gaps[~final]] = 32
    return out, owner


def ngrams(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of order ORDER at each symbol, and the row."""
    at = np.flatnonzero(owner >= 0)
    key = symbols[at].astype(np.uint64)
    for k in range(1, ORDER + 1):
        key = (key << np.uint64(8)) | symbols[at - k]
    return key, owner[at]


def runs(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal neighbours."""
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One run of all; the lists are emptied, so that their parts are not held during the sort."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(key, kind="stable")
    key = key[order]
    count = count[order]
    del order
    return runs(key, count)


def shorter(keys: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of a lower order from sorted ones of order ORDER."""
    return runs(keys >> np.uint64(8 * (ORDER - order)), counts)


def packed(numbers: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of sorted numbers byte place by byte place, so that equal high bytes compress."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


def occurrences(keys: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each context of ``order`` bytes was followed by something; none for contexts before the start of a text."""
    context = keys & np.uint64((1 << 8 * order) - 1)
    node, which = np.unique(context, return_inverse=True)
    inside = (node >> np.uint64(8 * max(0, order - 1))) != STOP if order else np.ones(len(node), bool)
    return node[inside], np.bincount(which, counts, len(node)).astype(np.int64)[inside]


class Index:
    """Numbers of known keys by open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left, place = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(left):
            free = self.slots[place] < 0
            self.slots[place[free]] = left[free]  # of equal places the last one wins
            lost = self.slots[place] != left
            left, place = left[lost], (place[lost] + 1) & ((1 << self.bits) - 1)
        used = self.slots >= 0
        self.keys[used] = keys[self.slots[used]]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for unknown ones."""
        place = self._home(keys)
        out = self.slots[place]
        open_ = np.flatnonzero((self.keys[place] != keys) & (out >= 0))
        place = place[open_]
        while len(open_):
            place = (place + 1) & ((1 << self.bits) - 1)
            got = self.slots[place]
            out[open_] = got
            more = (self.keys[place] != keys[open_]) & (got >= 0)
            open_, place = open_[more], place[more]
        return out


class Sorted:
    """The same for sorted keys by binary search, without a table of their own."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def _counts_of(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of sorted keys, 0 for others (contexts that reach before the start of a text)."""
    if not len(keys):
        return np.zeros(len(wanted), counts.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0)


class Trie:
    """``levels``: sorted keys and counts of each order, 0 to ORDER, closed under dropping context bytes.

    ``total`` is the number of symbols that were counted, those of n-grams outside the trie included. A shard has
    ``occurs``: for the orders above NEAR the occurrences of its contexts, which other shards hold as n-grams. ``base`` is a
    trie of the first levels, which are then not built again.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], total: int, occurs: dict | None = None, base: Trie | None = None):
        self.entries, self.nodes = (list(base.entries), list(base.nodes)) if base else ([], [])
        above = base.above if base else None
        find = Sorted if base else Index
        for k in range(len(self.entries), len(levels)):
            keys, counts = levels[k]
            counts = counts.astype(np.float64)
            context = keys & np.uint64((1 << 8 * k) - 1)
            node, which = np.unique(context, return_inverse=True)
            kept = np.bincount(which, counts, len(node))
            symbols = np.bincount(which, minlength=len(node)).astype(np.float64)
            # a context was followed by something as often as it occurred, but at the ends of texts
            full = np.maximum(kept, total if k == 0 else _counts_of(*levels[k - 1], node))
            if occurs and k in occurs:
                full = np.maximum(full, _counts_of(*occurs[k], node))
            missing = full - kept
            escape = missing + symbols / 2
            direct = np.log10(counts) - np.log10(kept + escape)[which]
            leave = np.log10(escape) - np.log10(kept + escape)
            if k == 0:
                rest = max(256 - len(keys), 1)
                chain, below = np.zeros(len(node)), np.full(len(node), -np.log10(rest))
                log_den = -below
            else:
                (up_node, up_kept, up_symbols, up_missing, up_chain), (up_keys, up_counts) = above, levels[k - 1]
                same = up_counts[np.searchsorted(up_keys, keys >> np.uint64(8))]
                seen = np.bincount(which, same, len(node))
                parent = np.searchsorted(up_node, node >> np.uint64(8))
                left = np.maximum(up_kept[parent] - seen, 0)
                weight = up_missing[parent] + (up_symbols[parent] - symbols) / 2
                rest = left + weight
                safe = rest > 0
                log_den = np.where(safe, np.log10(np.where(safe, rest, 1)), 0)
                # nothing left to code in the shorter context: the escape is certain
                step = np.where(safe & (left > 0), np.log10(np.where(weight > 0, weight, 1)) - log_den, 0)
                chain = up_chain[parent] + step
            self.entries.append((find(keys), direct, np.log10(counts)))
            self.nodes.append((find(node), leave + chain, -log_den - chain))
            above = (node, kept, symbols, missing, chain)
        self.above = above

    def code_lengths(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each symbol after its context."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        top = np.full(len(keys), np.nan)
        below = np.zeros(len(keys))
        for k in range(ORDER, -1, -1):
            key = keys[left] >> np.uint64(8 * (ORDER - k))
            index, direct, count = self.entries[k]
            number = index.find(key)
            hit = number >= 0
            at, number = left[hit], number[hit]
            first = np.isnan(top[at])
            out[at] = np.where(first, direct[number], count[number] + below[at] + np.where(first, 0, top[at]))
            left, key = left[~hit], key[~hit]
            index, leave, after = self.nodes[k]
            number = index.find(key & np.uint64((1 << 8 * k) - 1))
            known = number >= 0
            at, number = left[known], number[known]
            top[at] = np.where(np.isnan(top[at]), leave[number], top[at])
            below[at] = after[number]
        # order -1: the byte values that the empty context does not know
        out[left] = np.where(np.isnan(top[left]), -np.log10(256), top[left] + below[left])
        return out
