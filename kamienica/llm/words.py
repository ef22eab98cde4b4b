"""Words of many texts at once as numpy arrays: where they lie and 64-bit hashes, without a Python object per word.

Separators are ASCII, so words are found in the UTF-8 bytes. A word's hash is the sum of random numbers, one for each byte
value, weighted by powers of an odd base; sums over all prefixes of a block give it for every word by a difference, and the
inverse power makes it independent of the place. Words longer than LONG are hashed one by one. Texts are worked through in
blocks of about CHUNK bytes, cut between words, so that memory besides the result does not grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

CHUNK = 1 << 20  # bytes hashed at a time
LONG = 256  # bytes from which on a word is hashed on its own
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BLANKS = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hasher:
    """64-bit hashes of slices of a block; other seeds give independent ones."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.seed = seed
        self.value = rng.integers(1, 2 ** 63, 256, dtype=np.uint64)
        base = int(rng.integers(1, 2 ** 60)) * 8 + 5  # 5 modulo 8: the longest period among odd numbers
        self.powers = self._powers(base)
        self.inverse = self._powers(pow(base, -1, 2 ** 64))

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        steps = np.full(2 * CHUNK, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def slices(self, block: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(self.value[block] * self.powers[:len(block)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of a list of texts. `data` holds all texts; word i is data[start[i]:end[i]] and belongs to text `doc[i]`; `last`
    marks words behind which a piece ends; `hash` has one array for each seed."""

    def __init__(self, texts: Iterable[bytes], hashers: tuple[Hasher, ...], blanks: bytes = BLANKS, breaks: bytes = b""):
        texts = [t.translate(LOWER) for t in texts]
        self.data = b"\n".join(texts) + b"\n"
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        bytes_ = np.frombuffer(self.data, np.uint8)
        kind = np.zeros(256, np.int8)
        kind[list(blanks)] = 1
        kind[list(breaks)] = 2
        apart = kind[bytes_]
        ends_of_text = sizes.cumsum()
        apart[ends_of_text - 1] = 2
        inside = apart == 0
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.start, self.end = edges[0::2], edges[1::2]  # the last byte is a separator, so every word ends
        self.doc = np.searchsorted(ends_of_text, self.start, "right")
        stops = np.concatenate([[0], (apart == 2).cumsum()])
        self.last = np.ones(len(self.start), bool)  # a break between the end of a word and the start of the next
        self.last[:-1] = stops[self.start[1:]] > stops[self.end[:-1]]
        self.hash = tuple(self._hash(bytes_, h) for h in hashers)

    def _hash(self, bytes_: np.ndarray, hasher: Hasher) -> np.ndarray:
        found = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            first = self.start[at]
            if self.end[at] - first > LONG:  # a long word by itself
                found[at] = xxhash.xxh3_64_intdigest(self.data[first:self.end[at]], seed=hasher.seed)
                at += 1
                continue
            until = max(int(np.searchsorted(self.end, first + CHUNK, "right")), at + 1)
            starts, ends = self.start[at:until] - first, self.end[at:until] - first
            found[at:until] = hasher.slices(bytes_[first:first + ends[-1]], starts, ends)
            for i in np.flatnonzero(ends - starts > LONG) + at:
                found[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i]:self.end[i]], seed=hasher.seed)
            at = until
        return found

    def __len__(self) -> int:
        return len(self.start)

    def slice(self, first: int, last: int) -> bytes:
        """The bytes of the words from `first` to `last`, one blank between two."""
        if first == last:
            return self.data[self.start[first]:self.end[first]]
        return b" ".join(self.data[self.start[i]:self.end[i]] for i in range(first, last + 1))


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)
