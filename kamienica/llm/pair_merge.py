"""Byte-pair merging of many words at once in numpy.

All words that have the same number of symbols left advance together: every row of such a block makes the one merge of
lowest rank (leftmost among equals), becomes one symbol shorter, and joins the block of the next length. Pairs are looked
up in sorted keys; only the two pairs beside a merge are looked up again.
"""

from __future__ import annotations

from collections import defaultdict
from heapq import heapify, heappop, heappush

import numpy as np

BASE = 1 << 22  # above any symbol: pieces and code points beyond them
NEVER = np.int64(1 << 62)
LONG = 192  # words of more symbols are merged one by one, in n log n


class PairTable:
    """(left, right) -> (rank, merged symbol), as arrays sorted by pair."""

    def __init__(self, left, right, rank, merged):
        keys = np.asarray(left, np.int64) * BASE + np.asarray(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = np.asarray(rank, np.int64)[order]
        self.merged = np.asarray(merged, np.int64)[order]
        self.single = {}

    def find(self, left, right):
        """Rank of each pair (NEVER if it does not merge) and its place in the table."""
        wanted = left * BASE + right
        if not len(self.keys):
            return np.full(wanted.shape, NEVER), np.zeros(wanted.shape, np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER), at

    def pair(self, left: int, right: int):
        """The same for one pair in plain Python: (rank, merged) or None."""
        if not self.single:
            self.single = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        return self.single.get(left * BASE + right)


def merge_long(symbols: list[int], table: PairTable) -> list[int]:
    """One word, with a heap of candidate pairs over a linked list."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    value: list[int | None] = list(symbols)
    heap = []

    def offer(i, j):
        if 0 <= i and j < n and (found := table.pair(value[i], value[j])):
            heap.append((found[0], i, j, value[i], value[j], found[1]))
            return heap.pop()
        return None

    start = [c for i in range(n - 1) if (c := offer(i, i + 1))]
    heap = start
    heapify(heap)
    while heap:
        _, i, j, a, b, merged = heappop(heap)
        if value[i] != a or value[j] != b or after[i] != j:
            continue
        value[i], value[j] = merged, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n and (found := table.pair(value[left], value[right])):
                heappush(heap, (found[0], left, right, value[left], value[right], found[1]))
    return [v for v in value if v is not None]


def merge_words(words: list[np.ndarray], table: PairTable) -> list[np.ndarray]:
    """The symbols each word (an integer array) ends in, in order."""
    result: list[np.ndarray | None] = [None] * len(words)
    waiting = defaultdict(list)
    for i, word in enumerate(words):
        if len(word) > LONG:
            result[i] = np.asarray(merge_long(word.tolist(), table), np.int64)
        elif len(word) < 2:
            result[i] = word
        else:
            waiting[len(word)].append(i)
    symbols = who = ranks = places = None
    for n in range(max(waiting, default=0), 1, -1):
        fresh = waiting.get(n, [])
        if fresh:
            new = np.stack([words[i] for i in fresh]).astype(np.int64)
            new_ranks, new_places = table.find(new[:, :-1], new[:, 1:])
            if symbols is None or not len(who):
                symbols, who, ranks, places = new, np.asarray(fresh), new_ranks, new_places
            else:
                symbols, who = np.concatenate([symbols, new]), np.concatenate([who, fresh])
                ranks, places = np.concatenate([ranks, new_ranks]), np.concatenate([places, new_places])
        if symbols is None or not len(who):
            continue
        best = ranks.argmin(axis=1)
        rows = np.arange(len(who))
        more = ranks[rows, best] < NEVER
        if not more.all():
            for i, row in zip(who[~more].tolist(), symbols[~more]):
                result[i] = row
            symbols, who, ranks, places, best = symbols[more], who[more], ranks[more], places[more], best[more]
            rows = np.arange(len(who))
            if not len(who):
                continue
        merged = table.merged[places[rows, best]]
        shift = np.arange(n - 1)[None, :] + (np.arange(n - 1)[None, :] > best[:, None])
        symbols = np.take_along_axis(symbols, shift, axis=1)
        symbols[rows, best] = merged
        if n == 2:
            for i, row in zip(who.tolist(), symbols):
                result[i] = row
            break
        keep = np.arange(n - 2)[None, :] + (np.arange(n - 2)[None, :] >= best[:, None])
        ranks, places = np.take_along_axis(ranks, keep, axis=1), np.take_along_axis(places, keep, axis=1)
        for side in (-1, 0):  # the pair that ends in the new symbol, and the one that begins with it
            at = best + side
            has = (at >= 0) & (at < n - 2)
            r, a = rows[has], at[has]
            ranks[r, a], places[r, a] = table.find(symbols[r, a], symbols[r, a + 1])
    return result
