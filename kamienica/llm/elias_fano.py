"""Sorted whole numbers in about two bits more than log2(universe / count) each, and tries of n-grams made of them.

A sequence is cut into low bits, packed one behind the other, and high bits, written as gaps in a bit vector with a count of
ones in front of each word. Everything is a flat array, so that a trie can be written to a file and mapped into memory.
All lookups work on many positions or values at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)  # ones in a byte
PLACE = np.zeros((256, 8), np.uint8)  # place of the k-th one in a byte
for _byte in range(256):
    for _k, _bit in enumerate(i for i in range(8) if _byte >> i & 1):
        PLACE[_byte, _k] = _bit
U = np.uint64


def _select(words: np.ndarray, before: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th one of a bit vector; `before` has the ones in front of each word."""
    word = np.searchsorted(before, rank, "right") - 1
    left = rank - before[word]
    parts = np.ascontiguousarray(words[word]).view(np.uint8).reshape(-1, 8)
    upto = ONES[parts].cumsum(axis=1, dtype=np.int64)
    byte = (upto <= left[:, None]).sum(axis=1)
    every = np.arange(len(rank))
    left = left - np.where(byte > 0, upto[every, byte - 1], 0)
    return word * 64 + byte * 8 + PLACE[parts[every, byte], left]


class Sequence64:
    """A non-decreasing sequence. `arrays` are all there is to it, besides `shape` (count, low bits)."""

    def __init__(self, shape: tuple[int, int], arrays: Sequence[np.ndarray]):
        self.count, self.bits = shape
        self.low, self.high, self.ones, self.zeros = arrays

    @classmethod
    def of(cls, values: np.ndarray) -> Sequence64:
        values = values.astype(U)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros((n * bits >> 6) + 2, U)
        if bits:
            part, at = values & U((1 << bits) - 1), np.arange(n, dtype=U) * U(bits)
            word, off = (at >> U(6)).astype(np.int64), at & U(63)
            np.bitwise_or.at(low, word, part << off)
            over = np.flatnonzero(off + U(bits) > 64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U(64) - off[over]))
        above = values >> U(bits)
        length = (top >> bits) + n + 2  # a zero behind the last bucket as well
        flags = np.zeros(-(-length // 64) * 64, np.uint8)
        flags[above.astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(U)
        ones = np.concatenate([[0], ONES[high.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64).cumsum()])
        return cls((n, bits), [low, high, ones, np.arange(len(ones)) * 64 - ones])

    @property
    def shape(self) -> tuple[int, int]:
        return self.count, self.bits

    @property
    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ones, self.zeros]

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), U)
        place = at.astype(U) * U(self.bits)
        word, off = (place >> U(6)).astype(np.int64), place & U(63)
        more = np.where(off > 0, self.low[word + 1] << ((U(64) - off) & U(63)), U(0))
        return (self.low[word] >> off | more) & U((1 << self.bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at the places `at`."""
        if not len(at):
            return np.empty(0, U)
        return ((_select(self.high, self.ones, at) - at).astype(U) << U(self.bits)) | self._low(at)

    def _below(self, bucket: np.ndarray) -> np.ndarray:
        """How many values have high bits up to `bucket`."""
        last = self.zeros[-1] - 1
        inside = np.minimum(bucket, last)
        return np.where(bucket > last, self.count, _select(~np.asarray(self.high), self.zeros, inside) - inside)

    def successor(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The first place in [first, last) whose value is not below the one given, or `last`."""
        if not len(values):
            return np.empty(0, np.int64)
        bucket = (values >> U(self.bits)).astype(np.int64)
        low = values & U((1 << self.bits) - 1)
        a = np.where(bucket > 0, self._below(np.maximum(bucket - 1, 0)), 0)
        b = np.minimum(self._below(bucket), last)
        a = np.minimum(np.maximum(a, first), last)
        open_ = np.flatnonzero(a < b)
        while len(open_):
            middle = (a[open_] + b[open_]) >> 1
            less = self._low(middle) < low[open_]
            a[open_] = np.where(less, middle + 1, a[open_])
            b[open_] = np.where(less, b[open_], middle)
            open_ = open_[a[open_] < b[open_]]
        return a


class Trie:
    """Distinct n-grams of whole numbers, level by level. Level k holds the distinct beginnings of k + 1 words: each word is
    written relative to its context, as context * universe + word, so that a level is one rising sequence; pointers, rising
    too, tell where the successors of a context begin. A lookup narrows to the successors of the context found so far and
    searches the successor of the wanted word among them."""

    def __init__(self, universe: int, words: Sequence[Sequence64], pointers: Sequence[Sequence64]):
        self.universe, self.words, self.pointers = universe, words, pointers

    @classmethod
    def of(cls, grams: np.ndarray, universe: int) -> Trie:
        """`grams` in rising order, without repeats, one row each."""
        n, order = grams.shape
        words, pointers = [], []
        parent = np.zeros(n, np.int64)
        for level in range(order):
            fresh = np.ones(n, bool)
            fresh[1:] = (parent[1:] != parent[:-1]) | (grams[1:, level] != grams[:-1, level])
            if level:
                own = parent[fresh]
                pointers.append(Sequence64.of(np.searchsorted(own, np.arange(parent[-1] + 2 if n else 1))))
            words.append(Sequence64.of(parent[fresh].astype(U) * U(universe) + grams[fresh, level].astype(U)))
            parent = fresh.cumsum() - 1
        return cls(universe, words, pointers)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """The place of each n-gram in the order of building, or -1."""
        node, found = np.zeros(len(grams), np.int64), np.arange(len(grams))
        for level, words in enumerate(self.words):
            context = node[found]
            if level:
                first = self.pointers[level - 1].get(context).astype(np.int64)
                last = self.pointers[level - 1].get(context + 1).astype(np.int64)
            else:
                first, last = np.zeros(len(found), np.int64), np.full(len(found), words.count)
            value = context.astype(U) * U(self.universe) + grams[found, level].astype(U)
            at = words.successor(value, first, last)
            hit = at < last
            hit[hit] = words.get(at[hit]) == value[hit]
            node[found[hit]], found = at[hit], found[hit]
        place = np.full(len(grams), -1, np.int64)
        place[found] = node[found]
        return place

    def write(self, path: str) -> None:
        """All arrays one behind the other in one file."""
        with open(path, "wb") as file:
            for sequence in (*self.words, *self.pointers):
                for array in sequence.arrays:
                    file.write(array.astype(np.int64, copy=False).tobytes() if array.dtype != U else array.tobytes())

    def mapped(self, path: str) -> Trie:
        """The same trie over the file written, mapped into memory."""
        at, made = 0, []
        for sequence in (*self.words, *self.pointers):
            arrays = []
            for array in sequence.arrays:
                arrays.append(np.memmap(path, array.dtype, "r", at, array.shape))
                at += array.nbytes
            made.append(Sequence64(sequence.shape, arrays))
        return Trie(self.universe, made[:len(self.words)], made[len(self.words):])
