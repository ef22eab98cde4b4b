"""Scoring of texts by an n-gram model in Elias-Fano tries.

Texts are lower-cased (A-Z); their tokens are their words and one end. The model learns from the training texts, all of them
whole, and from everything in them: no n-gram and no word is left out, so its size follows the corpus. Probabilities are
smoothed by the next shorter context, P(w | c) = (n(c w) + KAPPA P(w | c without its first word)) / (n(c) + KAPPA), down to
single tokens, P(w) = (n(w) + 1) / (N + V + 1). Behind a training text's end stands the beginning of a text, as context.

How it is dealt out. Texts are gathered in blocks of about BLOCK bytes; a block is one row with its token sequence. Words meet
their counts and numbers in shards by their hash, n-grams theirs in shards by the hash of their context (a context that is
more than HOT of all tokens is dealt by its successors as well). A block sends each shard its distinct words or n-grams once,
with training counts; a shard adds up all counts, builds its trie, answers every block, and is gone. So counts, questions and
answers are one shuffle each way. A shard holds about SHARD n-grams, whatever the corpus; their number follows it.

A shard's trie has word numbers relative to their context, rising pointers, and log probabilities in 255 steps, each the mean
of as many occurrences; it lies in a file mapped into memory, read by successor search within the context found. N-grams that no
training text has have place 0 and take the smoothed remainder in the block.

Defined cases: a null text is empty: its only token is the end; a null id trains (it has no remainder); rows with one id are
rows of their own, all of them counted; with no training text every probability is 1 / (0 + 0 + 1); an empty table gives an
empty result; a word of any length is one word; further columns are ignored. Equal texts get equal scores in one run; the
probabilities' steps depend on the number of shards and so on the corpus alone.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kamienica.llm.elias_fano import Trie
from kamienica.llm.words import Hasher, Words, mix
from kamienica.session import settle

KAPPA = 20.0  # weight of the shorter context, in occurrences
BLOCK = 8 << 20  # bytes of text in a block
SHARD = 1_000_000  # words or n-grams, counted once a block, that a shard is meant for
HOT = 200_000  # occurrences of a context beyond which its successors are spread
STEPS = 255
END = 0  # number of the end token; words follow from 1
U = np.uint64
STEP = U(0x9E3779B97F4A7C15)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers, byte by byte in planes, compressed."""
    numbers = numbers.astype("<u8")
    width = max(1, -(-int(numbers.max()).bit_length() // 8)) if len(numbers) else 1
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    width, planes = data[0], np.frombuffer(zstandard.decompress(data[1:]), np.uint8)
    numbers = np.zeros((planes.size // width, 8), np.uint8)
    numbers[:, :width] = planes.reshape(width, -1).T
    return numbers.view("<u8").ravel()


def word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes % U(shards)).astype(np.int64)


# ---- blocks

def _blocks(key_type: pa.DataType) -> Callable:
    """Rows (block, keys, held, sizes, seq, words, counts): local word numbers, and per word its training count."""
    def row(keys: list, held: list, texts: list[bytes]) -> pa.RecordBatch:
        words = Words(texts, (Hasher(1), Hasher(2)))
        order = np.lexsort((words.hash[1], words.hash[0]))
        a, b = words.hash[0][order], words.hash[1][order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        kinds = fresh.cumsum() - 1
        often = np.bincount(kinds)
        rank = np.empty(len(often), np.int64)
        rank[np.argsort(-often, kind="stable")] = np.arange(1, len(often) + 1)  # common words get small numbers
        number = np.empty(len(order), np.int64)
        number[order] = rank[kinds]
        first = np.empty(len(often) + 1, np.int64)
        first[number[order[fresh]]] = order[fresh]
        named = [words.data[words.start[i]:words.end[i]] for i in first[1:].tolist()]
        sizes = np.bincount(words.doc, minlength=len(texts)) + 1
        trains = ~np.array(held, bool)
        counts = np.bincount(number, trains[words.doc], minlength=len(often) + 1).astype(np.int64)
        seq = np.zeros(sizes.sum(), np.int64)  # END where no word is put
        seq[np.arange(len(number)) + words.doc] = number
        values = [[int.from_bytes(os.urandom(7), "little")], [keys], [held], [sizes.tolist()], [pack(seq)],
                  [zstandard.compress(b"\n".join(named))], [pack(counts[1:])], [len(named)]]
        kinds_ = [pa.int64(), pa.list_(key_type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(),
                  pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds_)],
                                          names=["block", "keys", "held", "sizes", "seq", "words", "counts", "n_words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, texts, size = [], [], [], 0
        for batch in batches:
            for key, out, text in zip(*(batch.column(i) for i in range(3))):
                keys.append(key.as_py())
                held.append(out.as_py())
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BLOCK:
                    yield row(keys, held, texts)
                    keys, held, texts, size = [], [], [], 0
        if texts:
            yield row(keys, held, texts)
    return run


# ---- words: counts and numbers

ASKED = "shard long, block long, a binary, b binary, c binary, d binary"
ANSWER = "block long, level int, shard long, a binary, b binary, c binary"


def _row(schema: list[str], values: list) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    columns = [c.split() for c in schema]
    return pa.table({name: pa.array(v, kinds[kind]) for (name, kind), v in zip(columns, values)})


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    columns = schema.split(", ")
    return _row(columns, [list(v) for v in zip(*rows)] if rows else [[] for _ in columns])


def _ask_words(shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = zstandard.decompress(words)
                if not text:
                    continue
                named, counts = text.split(b"\n"), unpack(counts)
                shard = word_shard(Words([text], (Hasher(1),)).hash[0], shards)
                rows = []
                for s in np.unique(shard).tolist():
                    own = np.flatnonzero(shard == s)
                    rows.append((s, block, zstandard.compress(b"\n".join([named[i] for i in own.tolist()])),
                                 pack(counts[own]), None, None))
                yield from _table(ASKED, rows).to_batches()
    return run


def _answer_words(shards: int) -> Callable:
    """Counts of all words of a shard and numbers by falling count; a row without block has how many of them train."""
    def run(asked: pa.Table) -> pa.Table:
        shard = asked.column("shard")[0].as_py()
        total: dict[bytes, int] = {}
        lists = []
        for words, counts in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist()):
            named = zstandard.decompress(words).split(b"\n")
            lists.append(named)
            for word, n in zip(named, unpack(counts).tolist()):
                total[word] = total.get(word, 0) + n
        number = {w: 1 + i * shards + shard for i, w in enumerate(sorted(total, key=lambda w: (-total[w], w)))}
        rows = [(None, 1, shard, sum(n > 0 for n in total.values()).to_bytes(8, "little"), None, None)]
        for block, named in zip(asked.column("block").to_pylist(), lists):
            rows.append((block, 1, shard, pack(np.array([number[w] for w in named], U)),
                         pack(np.array([total[w] for w in named], U)), None))
        return _table(ANSWER, rows)
    return run


# ---- n-grams

class Level:
    """The distinct n-grams of one order in a block. `at` has each token's n-gram, or -1 near the beginning of a text."""

    def __init__(self, at, context, word, first, hashes, p=None, count=None):
        self.at, self.context, self.word, self.first, self.hash = at, context, word, first, hashes
        self.p, self.count = p, count


class Block:
    """A block with the answers so far: levels of words and n-grams with smoothed probabilities and training counts."""

    def __init__(self, row: dict, answers: list[dict], tokens: int, kinds: int, trained: int, shards: list[int], kappa: float):
        self.row, self.kappa, self.shards = row, kappa, shards
        self.sizes = np.array(row["sizes"], np.int64)
        self.seq = unpack(row["seq"]).astype(np.int64)
        self.place = np.arange(len(self.seq)) - np.repeat(self.sizes.cumsum() - self.sizes, self.sizes)
        self.trains = np.repeat(~np.array(row["held"], bool), self.sizes)
        by_level: dict[int, dict[int, dict]] = {}
        for answer in answers:
            by_level.setdefault(answer["level"], {})[answer["shard"]] = answer
        text = zstandard.decompress(row["words"])
        ids = np.zeros(row["n_words"] + 1, U)
        count = np.full(row["n_words"] + 1, trained)  # of the end: one in each training text
        if text:
            shard = word_shard(Words([text], (Hasher(1),)).hash[0], shards[0])
            order = np.argsort(shard, kind="stable")
            parts = [by_level[1][s] for s in np.unique(shard).tolist()]
            ids[1 + order] = np.concatenate([unpack(a["a"]) for a in parts])
            count[1 + order] = np.concatenate([unpack(a["b"]) for a in parts]).astype(np.int64)
        self.ids = ids
        self.levels = [Level(self.seq, None, np.arange(len(ids)), None, mix(ids + STEP), (count + 1) / (tokens + kinds + 1), count)]
        for order in range(2, max(by_level, default=1) + 1):
            self._answered(self.next_level(order), by_level.get(order, {}), order)

    def next_level(self, order: int) -> Level:
        """The n-grams of `order` words. The token in front of a text's first is taken to be an end."""
        below = self.levels[-1]
        before = np.concatenate([[END if order == 2 else -1], below.at[:-1]])
        if order == 2:
            before[self.place == 0] = END
        fits = (self.place >= order - 2) & (before >= 0)
        code = (before[fits].astype(U) << U(32)) | self.seq[fits].astype(U)
        distinct, first, inverse = np.unique(code, return_index=True, return_inverse=True)
        at = np.full(len(self.seq), -1, np.int64)
        at[fits] = inverse
        context, word = (distinct >> U(32)).astype(np.int64), (distinct & U(2 ** 32 - 1)).astype(np.int64)
        return Level(at, context, word, np.flatnonzero(fits)[first], mix(below.hash[context] * STEP + self.ids[word]))

    def lower(self, level: Level) -> tuple[np.ndarray, np.ndarray]:
        """(probability in the shorter context, count of the context) of each n-gram."""
        below = self.levels[-1]
        return below.p[below.at[level.first]], below.count[level.context]

    def dealt(self, level: Level, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(order by shard, shard in that order)."""
        below = self.levels[-1]
        hot = below.count[level.context] > HOT
        shard = (np.where(hot, level.hash, below.hash[level.context]) % U(self.shards[order - 1])).astype(np.int64)
        dealt = np.argsort(shard, kind="stable")
        return dealt, shard[dealt]

    def words_of(self, level: Level, order: int) -> np.ndarray:
        """Global word numbers, one row an n-gram."""
        columns, at, context = [self.ids[level.word]], level, level.context
        for below in self.levels[::-1][:order - 2]:
            columns.append(self.ids[below.word[context]])
            context = below.context[context]
        columns.append(self.ids[context])
        return np.column_stack(columns[::-1])

    def ask(self, order: int) -> list[tuple]:
        level = self.next_level(order)
        used = level.at >= 0
        counts = np.bincount(level.at[used], self.trains[used], minlength=len(level.word)).astype(np.int64)
        lower, context = self.lower(level)
        dealt, shard = self.dealt(level, order)
        grams = self.words_of(level, order)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        rows = []
        for a, b in zip(cuts, cuts[1:]):
            own = dealt[a:b]
            rows.append((int(shard[a]), self.row["block"], pack(grams[own].T.ravel()), pack(counts[own]),
                         lower[own].astype("<f4").tobytes(), pack(context[own])))
        return rows

    def _answered(self, level: Level, answers: dict[int, dict], order: int) -> None:
        lower, context = self.lower(level)
        level.p = self.kappa * lower / (context + self.kappa)  # of what no training text has
        level.count = np.zeros(len(level.word), np.int64)
        dealt, shard = self.dealt(level, order)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:]):
            answer, own = answers[int(shard[a])], dealt[a:b]
            steps = unpack(answer["a"]).astype(np.int64)
            logs = np.frombuffer(answer["c"], "<f4").astype(float)
            seen = steps > 0
            level.p[own[seen]] = 10.0 ** logs[steps[seen] - 1]
            level.count[own] = unpack(answer["b"]).astype(np.int64)
        self.levels.append(level)

    def scores(self, tokens: int, kinds: int) -> dict[str, list]:
        words = self.levels[0]
        log = np.log10(words.p[self.seq])
        best = log.copy()
        for level in self.levels[1:]:
            used = level.at >= 0
            best[used] = np.log10(level.p[level.at[used]])
        starts = self.sizes.cumsum() - self.sizes
        return {"n_tokens": self.sizes, "n_known": np.add.reduceat((words.count[self.seq] > 0).astype(np.int64), starts),
                "train_tokens": np.full(len(starts), tokens), "base_score": np.add.reduceat(log, starts),
                "score": np.add.reduceat(best, starts)}


def quantised(logs: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(mean of each step, step from 1 of each value): equally many occurrences a step; few distinct values are kept as they
    are."""
    distinct, place = np.unique(logs, return_inverse=True)
    if len(distinct) <= steps:
        return distinct.astype("<f4"), place + 1
    weight = np.bincount(place, counts)
    middle = weight.cumsum() - weight / 2
    step = np.minimum((middle * steps / weight.sum()).astype(np.int64), steps - 1)
    _, step = np.unique(step, return_inverse=True)
    return (np.bincount(step, weight * distinct) / np.bincount(step, weight)).astype("<f4"), step[place] + 1


def _answer_grams(order: int, kappa: float) -> Callable:
    """Builds the trie of a shard and answers all its blocks."""
    def run(asked: pa.Table) -> pa.Table:
        shard, blocks = asked.column("shard")[0].as_py(), asked.column("block").to_pylist()
        grams = [unpack(a).reshape(order, -1).T for a in asked.column("a").to_pylist()]
        sizes = [len(g) for g in grams]
        grams = np.concatenate(grams)
        counts = np.concatenate([unpack(b) for b in asked.column("b").to_pylist()]).astype(np.int64)
        lower = np.concatenate([np.frombuffer(c, "<f4") for c in asked.column("c").to_pylist()]).astype(float)
        context = np.concatenate([unpack(d) for d in asked.column("d").to_pylist()]).astype(np.int64)
        trained = np.flatnonzero(counts)
        by = trained[np.lexsort(grams[trained].T[::-1])]
        found = np.full(len(grams), -1, np.int64)
        logs, steps, total = np.empty(0, "<f4"), np.empty(0, np.int64), np.empty(0, np.int64)
        if len(by):
            fresh = np.ones(len(by), bool)
            fresh[1:] = (grams[by][1:] != grams[by][:-1]).any(axis=1)
            first = by[fresh]
            total = np.add.reduceat(counts[by], np.flatnonzero(fresh))
            logs, steps = quantised(np.log10((total + kappa * lower[first]) / (context[first] + kappa)), total)
            trie = Trie.of(grams[first], int(grams.max()) + 1)
            handle, path = tempfile.mkstemp()
            os.close(handle)
            try:
                trie.write(path)
                found = trie.mapped(path).find(grams)
            finally:
                os.unlink(path)
        step = np.zeros(len(grams), np.int64)
        number = np.zeros(len(grams), np.int64)
        hit = found >= 0
        step[hit], number[hit] = steps[found[hit]], total[found[hit]]
        ends = np.cumsum(sizes)
        rows = [(block, order, shard, pack(step[z - n:z]), pack(number[z - n:z]), logs.tobytes())
                for block, n, z in zip(blocks, sizes, ends)]
        return _table(ANSWER, rows)
    return run


# ---- the whole

def score(docs: DataFrame, held_out, order: int = 2, kappa: float = KAPPA, key: str = "doc_id", text: str = "text",
          shard_size: int = SHARD) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score); texts where `held_out` is true do not train."""
    spark, kind = docs.sparkSession, docs.schema[key].dataType
    name = kind.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    blocks = settle(slim.mapInArrow(_blocks(to_arrow_type(kind)),
                                    f"block long, keys array<{name}>, held array<boolean>, sizes array<long>, seq binary, "
                                    "words binary, counts binary, n_words long"))
    trains = F.expr("aggregate(zip_with(held, sizes, (h, n) -> if(h, 0L, n)), 0L, (x, y) -> x + y)")
    tokens, trained, all_words, all_tokens = blocks.agg(
        F.sum(trains), F.sum(F.expr("size(filter(held, h -> not h))").cast("long")), F.sum("n_words"),
        F.sum(F.expr("aggregate(sizes, 0L, (x, y) -> x + y)"))).first()
    tokens, trained, all_words, all_tokens = (x or 0 for x in (tokens, trained, all_words, all_tokens))
    shards = [max(1, -(-all_words // shard_size))] + [max(1, -(-all_tokens // shard_size))] * (order - 1)
    asked = blocks.select("block", "words", "counts").mapInArrow(_ask_words(shards[0]), ASKED)
    answers = settle(asked.groupBy("shard").applyInArrow(_answer_words(shards[0]), ANSWER))
    kinds = sum(int.from_bytes(r["a"], "little") for r in answers.where("block IS NULL").select("a").collect())  # a number a shard
    kinds += trained > 0
    answers = answers.where("block IS NOT NULL")
    given = {"tokens": tokens, "kinds": kinds, "trained": trained, "shards": shards, "kappa": kappa}

    def ask(level: int) -> Callable:
        def run(own: pa.Table, heard: pa.Table) -> pa.Table:
            return _table(ASKED, Block(own.to_pylist()[0], heard.to_pylist(), **given).ask(level))
        return run

    def result(own: pa.Table, heard: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        found = Block(row, heard.to_pylist(), **given).scores(tokens, kinds)
        return pa.table({key: own.column("keys").combine_chunks().flatten(), "held_out": pa.array(row["held"], pa.bool_()),
                         **{c: pa.array(v) for c, v in found.items()}})

    for level in range(2, order + 1):
        asked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(ask(level), ASKED)
        found = settle(asked.groupBy("shard").applyInArrow(_answer_grams(level, kappa), ANSWER))
        answers = answers.unionAll(found)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        result, f"`{key}` {name}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
