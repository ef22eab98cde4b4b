"""SentencePiece encoding and decoding in numpy, straight from a model file.

A text is cut into words that no piece crosses; a task encodes each distinct word once, all words of one length together:

* `search="viterbi"`: the pieces of the best sum of scores, by batched Viterbi. The hashes of all substrings of a block of words
  probe the sorted hashes of the pieces; then all words advance together, end by end, and the maximum over the pieces that
  end there is kept with a back pointer. Sums are doubles; of equal ones the longest last piece wins.
* `search="model"` (the default): what the model file itself asks for. That is the same for unigram models. The ids of
  pair-merging models are defined by merges in order of score, not by a sum; their words of one length are merged together
  (see `pair_merge`), every pair of pieces whose concatenation is a piece being found in sorted keys.

Characters without a piece become byte pieces where the model has them, else the unknown piece.

Defined cases: a null text gives null pieces, an empty one no pieces; a text holding the blank mark U+2581 decodes to a
blank there, as it does in the library; repeated rows are encoded alike; an empty table gives an empty result; input
columns with the names of result columns are replaced. Only models that leave texts as they are (no character map, no
removal of blanks) are taken; others raise ValueError.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.llm.pair_merge import PairTable, merge_words

RESULT = ("pieces", "n_pieces", "decoded")
BLANK = "▁"
#: Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, PAIRS = 1, 2
UNKNOWN_PENALTY = 10.0
WORD = regex.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
KEPT = 200_000  # encoded words a task remembers before it starts anew
CHUNK = 1 << 20  # characters handled at a time
BLOCK = 1 << 15  # characters of words that advance together
SLOTS = 20  # leading bits of a hash by which the sorted keys are entered
MIX = np.uint64(0x9E3779B97F4A7C15)


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield number, data[at:at + size]
            at += size


@dataclass
class Model:
    pieces: list[str]
    scores: np.ndarray
    kinds: list[int]
    kind: int = UNIGRAM
    prefix: bool = True
    byte_ids: dict[int, int] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Model:
        with open(path, "rb") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, data: bytes) -> Model:
        pieces, scores, kinds, kind, prefix, squeeze, charmap = [], [], [], UNIGRAM, True, True, b""
        for number, value in fields(data):
            if number == 1:
                own = dict(fields(value))
                pieces.append(own.get(1, b"").decode())
                scores.append(struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0])
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                kind = dict(fields(value)).get(3, UNIGRAM)
            elif number == 3:
                own = dict(fields(value))
                prefix, squeeze, charmap = bool(own.get(3, 1)), bool(own.get(4, 1)), own.get(2, b"")
        if kind not in (UNIGRAM, PAIRS) or squeeze or charmap or USER in kinds:
            raise ValueError("only plain unigram and pair-merging models that keep texts as they are")
        byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == BYTE}
        return cls(pieces, np.array(scores, np.float32), kinds, kind, prefix, byte_ids)

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    def normal(self) -> dict[str, int]:
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}


class Encoder:
    """Words to piece ids; ids from `base` on stand for characters without a piece."""

    def __init__(self, model: Model, search: str = "model"):
        if search not in ("model", "viterbi"):
            raise ValueError(f"no search of this name: {search}")
        self.model, self.base = model, len(model.pieces)
        self.merging = search == "model" and model.kind == PAIRS
        self.ids = model.normal()
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("pieces that go on behind a blank are not taken")
        self.longest = max(map(len, self.ids), default=1)
        if self.merging:
            left, right, rank, merged = [], [], [], []
            for piece, i in self.ids.items():
                for cut in range(1, len(piece)):
                    a, b = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                    if a is not None and b is not None:
                        left.append(a), right.append(b), merged.append(i)
                        rank.append(-model.scores[i])
            order = np.unique(np.array(rank, np.float64), return_inverse=True)[1]
            self.table = PairTable(left, right, order, merged)
        else:
            self._sort_keys()

    def _sort_keys(self) -> None:
        """The hashes of the pieces in order, and where those of each run of leading bits begin."""
        hashes, values = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for n, texts in by_length(self.ids):
            hashes.append(seal(hash_prefixes(code_points(texts, n))[-1], n))
            values.append(np.array([self.ids[t] for t in texts], np.int64))
        keys, values = np.concatenate(hashes), np.concatenate(values)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.int32)
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        slots = (self.keys >> np.uint64(64 - SLOTS)).astype(np.int64)
        self.first = np.full(1 << SLOTS, -1, np.int32)
        self.first[slots[::-1]] = np.arange(len(slots), dtype=np.int32)[::-1]
        self.crowd = int(np.bincount(slots).max()) if len(slots) else 0
        self.scores = self.model.scores.astype(np.float64)
        self.lowest = min((self.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY

    def _symbol(self, text: str) -> int | None:
        found = self.ids.get(text)
        return found if found is not None else self.base + ord(text) if len(text) == 1 else None

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as packed 32-bit integers, characters without a piece spelled out in bytes."""
        if self.merging:
            letters = {c: self._symbol(c) for c in set().union(*words)}
            merged = merge_words([np.array([letters[c] for c in w], np.int64) for w in words], self.table)
            return [self._spelled(row) for row in merged]
        result = [b""] * len(words)
        for n, who in by_length(range(len(words)), lambda i: len(words[i])):
            step = max(1, BLOCK // max(n, 1))
            for at in range(0, len(who) if n else 0, step):
                some = who[at:at + step]
                flat, ends = self._viterbi(code_points([words[i] for i in some], n))
                data, bounds = flat.tobytes(), [0, *(4 * ends).tolist()]
                for i, begin, end in zip(some, bounds, bounds[1:]):
                    result[i] = data[begin:end]
                odd = np.searchsorted(ends, np.flatnonzero(flat >= self.base), side="right")
                for k in set(odd.tolist()):
                    result[some[k]] = self._spelled(np.frombuffer(result[some[k]], np.int32))
        return result

    def _spelled(self, row: np.ndarray) -> bytes:
        out: list[int] = []
        for i in row.tolist():
            if i < self.base:
                out.append(i)
            elif self.model.byte_ids:
                out += [self.model.byte_ids[b] for b in chr(i - self.base).encode()]
            elif not out or out[-1] != self.model.unknown:  # a run of unknown characters is one unknown piece
                out.append(self.model.unknown)
        return np.array(out, np.int32).tobytes()

    def _found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are keys, and the pieces these stand for."""
        at = self.first[(hashes >> np.uint64(64 - SLOTS)).astype(np.int64)]
        place = np.flatnonzero(at >= 0)
        at, wanted = at[place], hashes[place]
        for _ in range(self.crowd - 1):
            at += self.keys[at] < wanted
            np.minimum(at, len(self.keys) - 1, out=at)
        hit = self.keys[at] == wanted
        return place[hit], self.values[at[hit]]

    def _viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length (a column each), one word after the other, and where each word's end."""
        n, m = codes.shape
        prefixes, wide = hash_prefixes(codes), min(n, self.longest)
        best, back = np.full((wide + n, m), -np.inf), np.zeros((n, m), np.uint8 if wide < 256 else np.int32)
        best[wide - 1], widths = 0, np.arange(wide, 0, -1).astype(back.dtype)[:, None]
        own, step = np.zeros((n, m), np.int32), max(1, BLOCK // m)
        for begin in range(0, n, step):  # a long word goes stretch by stretch
            stop = min(begin + step, n)
            gain, piece = self._ending(codes, prefixes, begin, stop, wide)
            for end in range(begin, stop):
                sums = best[end:end + wide] + gain[end - begin]
                top = sums.max(axis=0)
                best[end + wide] = top
                np.max((sums == top) * widths, axis=0, out=back[end])  # of equal sums the longest piece
            at = wide - back[begin:stop].astype(np.int64)
            own[begin:stop] = np.take_along_axis(piece, at[:, None], axis=1)[:, 0]
        taken, chosen = np.zeros((m, n), bool), np.zeros((m, n), np.int32)
        row, end = np.arange(m), np.full(m, n - 1)
        while len(row):
            width = back[end, row].astype(np.int64)
            taken[row, end], chosen[row, end] = True, own[end, row]
            end = end - width
            on = end >= 0
            row, end = row[on], end[on]
        return chosen[taken], np.cumsum(taken.sum(axis=1))

    def _ending(self, codes: np.ndarray, prefixes: np.ndarray, begin: int, stop: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of what ends at each place from `begin` to `stop`, the widest first; -inf where no piece does."""
        m = codes.shape[1]
        gain, piece = np.full((stop - begin, wide, m), -np.inf), np.zeros((stop - begin, wide, m), np.int32)
        for width in range(1, min(wide, stop) + 1):
            power, low = np.uint64(pow(int(MIX), width, 1 << 64)), max(begin, width - 1)
            hashes = prefixes[low + 1:stop + 1] - prefixes[low + 1 - width:stop + 1 - width] * power
            place, ids = self._found(seal(hashes, width).ravel())
            end, row = place // m + low - begin, place % m
            gain[end, wide - width, row], piece[end, wide - width, row] = self.scores[ids], ids
        alone = np.isneginf(gain[:, -1])
        gain[:, -1][alone], piece[:, -1][alone] = self.lowest, self.base + codes[begin:stop][alone]
        return gain, piece


def by_length(items, length=len) -> list[tuple[int, list]]:
    out: dict[int, list] = {}
    for item in items:
        out.setdefault(length(item), []).append(item)
    return list(out.items())


def code_points(words: list[str], n: int) -> np.ndarray:
    """Words of n characters as columns."""
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.ascontiguousarray(raw.reshape(len(words), n).T).astype(np.int64)


def hash_prefixes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of every prefix of each column, the empty one first."""
    out = np.zeros((codes.shape[0] + 1, codes.shape[1]), np.uint64)
    for j in range(codes.shape[0]):
        out[j + 1] = out[j] * MIX + codes[j].astype(np.uint64) + np.uint64(1)
    return out


def seal(hashes: np.ndarray, length: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(length)
    return (mixed ^ (mixed >> np.uint64(32))) * MIX


def text_encoder(model: Model, search: str = "model"):
    """A function from texts to arrays of their piece ids; keeps the words it has encoded, as packed integers."""
    encoder, known = Encoder(model, search), {}

    def encode(texts: list[str]) -> list[np.ndarray]:
        if len(known) > KEPT:
            known.clear()
        cut = [WORD.findall((BLANK if model.prefix and t else "") + t.replace(" ", BLANK)) for t in texts]
        new = list(set().union(*cut) - known.keys())
        known.update(zip(new, encoder.encode(new)))
        return [np.frombuffer(b"".join([known[w] for w in words]), np.int32) for words in cut]

    return encode


def text_decoder(model: Model):
    """A function from piece ids to the text; bytes that are no text become U+FFFD."""
    spelled = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN
               else p.replace(BLANK, " ").encode() for p, k in zip(model.pieces, model.kinds)]

    def decode(ids) -> str:
        text = b"".join([spelled[i] for i in ids]).decode(errors="replace")
        return text[1:] if model.prefix and text.startswith(" ") else text

    return decode


def _converted(docs: DataFrame, path: str, text: str, and_back: bool, search: str) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(Model.load(path))  # bounded by the model file
    names = RESULT if and_back else RESULT[:2]
    kept = [c for c in docs.columns if c.lower() not in names]
    own = [f"__row{i}" for i in range(len(kept))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(kept, own)], F.col(text).alias("__text"))
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("pieces", T.ArrayType(T.IntegerType()))] + [
        T.StructField("decoded", T.StringType())] * and_back)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, to_text = text_encoder(model.value, search), text_decoder(model.value)
        for batch in batches:
            at, column = 0, batch.column(len(own))
            for part in text_runs(column):
                ids = to_ids([t or "" for t in part])
                there = [t is not None for t in part]
                columns = [c.slice(at, len(part)) for c in batch.columns[:-1]]
                columns.append(packed(ids, there))
                if and_back:
                    columns.append(pa.array([to_text(row) if t else None for row, t in zip(ids, there)], pa.string()))
                at += len(part)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = rows.mapInArrow(convert, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(kept, own)], "pieces", *["decoded"] * and_back).withColumn(
        "n_pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long"))


def text_runs(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column in order, about a chunk of characters at a time, so that few are held as Python strings."""
    run, size = [], 0
    for value in column:
        run.append(value.as_py())
        size += len(run[-1] or "")
        if size >= CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def packed(rows: list[np.ndarray], there: list[bool]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *rows]), pa.int32()),
                                    mask=pa.array([not t for t in there], pa.bool_()))


def encode(docs: DataFrame, path: str, text: str = "text", search: str = "model") -> DataFrame:
    """Every document with `pieces` (ids) and `n_pieces`."""
    return _converted(docs, path, text, False, search)


def encode_and_decode(docs: DataFrame, path: str, text: str = "text", search: str = "model") -> DataFrame:
    """Every document with `pieces`, `n_pieces` and `decoded`, the text of these pieces, by one Python process a task."""
    return _converted(docs, path, text, True, search)


def decode(encoded: DataFrame, path: str, pieces: str = "pieces") -> DataFrame:
    """Adds `decoded`, the text of the piece ids."""
    model = encoded.sparkSession.sparkContext.broadcast(Model.load(path))

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = text_decoder(model.value)
        for batch in batches:
            yield pd.Series([None if ids is None else run(ids) for ids in batch], dtype=object)

    return encoded.select(*[c for c in encoded.columns if c.lower() != "decoded"], texts(F.col(pieces)).alias("decoded"))
