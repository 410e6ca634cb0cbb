"""Burrows-Wheeler transforms of sets of byte strings, and their merge by interleave refinement.

``Transform`` holds one shard's strings: the rows are the strings'
suffixes in sorted order (as far as ``depth`` bytes; a string's end sorts
before every byte), and a row's symbol is what stands before its suffix.

``merge`` interleaves the rows of several transforms and never compares
suffixes.  At first all rows are one block.  A refinement deals the rows in their present order by
their symbols, here the ``STEP`` bytes before the suffix: the row of suffix p then
stands for suffix p - STEP, and rows fall into one block where the symbols are equal and the rows came from one block.
After h bytes of refinement two rows are in one block exactly if their suffixes
share a prefix of h bytes, so the blocks left after ``length`` bytes are
the repeated intervals: all places of one string of that length.  A row that is alone in its block
(and whose string counts once) has no repeat, nor has any row that would be
refined from it, so it is left out from there on.
"""

from __future__ import annotations

import numpy as np

STEP = 40  # bytes of one refinement
UNIT = 5  # bytes before a row that its transform holds; as a number they sort in one pass with the row's place


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``key`` (numbers below 2**bits), ties by place, and whether each place in it starts another key."""
    n = len(key)
    if bits + n.bit_length() <= 63:  # keys and places fit one number, and sorting numbers is fast
        both = (key << n.bit_length()) | np.arange(n)
        both.sort()
        order, ordered = both & ((1 << n.bit_length()) - 1), both >> n.bit_length()
    else:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
    new = np.ones(n, dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return order, new


def _ranked(key: np.ndarray, bits: int) -> np.ndarray:
    """The rank of each of ``key`` (numbers below 2**bits), equal for equal ones."""
    order, new = _sorted(key, bits)
    rank = np.empty(len(key), dtype=np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - 1
    return rank


class Transform:
    """Sorted suffixes of one shard's strings; ``weights`` are the strings' numbers of copies."""

    def __init__(self, strings: list[bytes], weights: list[int], depth: int):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.base = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]  # one place more for each string's end
        n = int((sizes + 1).sum())
        data = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
        self.string = np.repeat(np.arange(len(strings)), sizes + 1)
        self.offset = np.arange(n) - self.base[self.string]
        left = sizes[self.string] - self.offset  # bytes of each suffix
        self.weights = np.asarray(weights, dtype=np.int64)
        # Four bytes of nine bits each; 0 stands for the end.
        key = np.zeros(n, dtype=np.int64)
        for i in range(4):
            key <<= 9
            if i >= n:
                continue
            key[: n - i] |= np.where(left[: n - i] > i, data[i:].astype(np.int64) + 1, 0)
        self.order, new = _sorted(key, 36)
        rank = np.empty(n, dtype=np.int64)  # the place of the first row with these bytes
        bits, h = n.bit_length(), 4
        where, rows = np.arange(n), self.order
        while True:
            first = np.flatnonzero(new)
            size = np.diff(first, append=len(new))
            rank[rows] = np.repeat(where[first], size)
            where = where[np.repeat(size > 1, size)]  # a row that shares its bytes with no other has its place
            if h >= depth or not len(where):
                break
            rows = self.order[where]
            far = left[rows] >= h
            after = np.where(far, rank[np.where(far, rows + h, 0)] + 1, 0)
            by, new = _sorted((rank[rows] << bits) | after, 2 * bits)
            rows = rows[by]
            self.order[where] = rows
            h *= 2
        self.row_of = np.empty(n, dtype=np.int64)
        self.row_of[self.order] = np.arange(n)
        before = np.zeros(n, dtype=np.int64)
        for i in range(1, min(UNIT, n) + 1):
            before[i:] |= data[: n - i].astype(np.int64) << (8 * (i - 1))
        self.symbols = before[self.order]  # the ``UNIT`` bytes before, of rows whose offset is as large

    def rows_from(self, offset: int) -> np.ndarray:
        """Rows whose suffix starts at ``offset`` or later in its string, in order."""
        return np.flatnonzero(self.offset[self.order] >= offset)


def merge(shards: list[Transform], length: int, step: int | None = None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each shard (string, offset, interval) of the ``length``-byte strings that occur at least twice over all shards."""
    raw = np.concatenate([t.symbols for t in shards])
    first = np.concatenate(([0], np.cumsum([len(t.order) for t in shards])))  # a shard's first row among all

    def go_back(by: int) -> np.ndarray:
        """Each row's row of the suffix that starts ``by`` bytes earlier."""
        return np.concatenate([a + t.row_of[np.maximum(t.order - by, 0)] for t, a in zip(shards, first)]).astype(np.int32)

    step = step or STEP
    rows = np.concatenate([a + t.rows_from(length) for t, a in zip(shards, first)])
    weight = np.concatenate([np.minimum(t.weights, 2)[t.string[t.order[t.rows_from(length)]]] for t in shards]).astype(np.int32)
    block = np.zeros(len(rows), dtype=np.int32)
    by = 0
    for width in [step] * (length // step) + [length % step] * (length % step > 0):
        if not len(rows):
            break
        if width != by:
            back, symbol_of, by = go_back(width), _symbols(raw, go_back, width), width
        dealt = np.sort((symbol_of[rows].astype(np.int64) << 32) | np.arange(len(rows)))
        came = dealt & 0xFFFFFFFF
        symbol, was = dealt >> 32, block[came]
        new = np.empty(len(rows), dtype=bool)
        new[0] = True
        np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
        new[1:] |= was[1:] != was[:-1]
        heads, weight = np.flatnonzero(new), weight[came]
        stays = np.add.reduceat(weight, heads) >= 2
        block = np.cumsum(new, dtype=np.int32) - 1
        kept = np.flatnonzero(stays[block])
        rows, block, weight = back[rows[came[kept]]], block[kept], weight[kept]
    out = []
    shard = np.searchsorted(first, rows, side="right") - 1
    for i, t in enumerate(shards):
        mine = shard == i
        at = t.order[rows[mine] - first[i]]
        out.append((t.string[at], t.offset[at], block[mine]))
    return out


def _symbols(raw: np.ndarray, go_back, width: int) -> np.ndarray:
    """Numbers for the ``width`` bytes before each row, equal for equal bytes; ``raw`` holds ``UNIT`` of them."""
    odd, units, size = width % UNIT, width // UNIT, UNIT
    got, done = (_ranked(raw & ((1 << 8 * odd) - 1), 8 * odd), odd) if odd else (None, 0)
    unit = _ranked(raw, 8 * UNIT) if units else None
    while units:
        if units & 1:
            got, done = unit if got is None else _pairs(unit[go_back(done)], got), done + size
        units >>= 1
        if units:
            unit, size = _pairs(unit[go_back(size)], unit), 2 * size
    return got


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    bits = len(a).bit_length()
    return _ranked((a.astype(np.int64) << bits) | b, 2 * bits)
