"""Token counts of a byte-level pair-merging vocabulary.

Whole-token shortcut: every vocabulary string is encoded once, offline; those that come out as one token are proved
whole. A pre-token that is one of them counts 1 at once, without any merge; only the rest is merged, each distinct
pre-token once per task and together with all others of its length. The proved strings are bounded by the vocabulary.

Special strings inside texts are cut out first and count one token each. Texts are counted whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens; lone surrogates cannot occur in Spark strings; input columns
with the names of result columns are replaced; repeated rows are counted alike.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kamienica.llm.pair_merge import PairTable, merge_words

RESULT = ("n_bytes", "n_tokens", "over_limit")
#: Fixed value: how byte-level vocabularies cut a text into pre-tokens.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CHUNK = 1 << 21  # characters handled at a time
KEPT = 400_000  # counts of merged pre-tokens a task remembers before it starts anew


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    whole: frozenset[bytes]  # strings proved to encode alone as one token
    first: np.ndarray  # the token of each byte
    table: PairTable
    special: tuple[str, ...]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        ids, letters = data["model"]["vocab"], byte_letters()
        byte_of = {letter: b for b, letter in letters.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        table = PairTable([ids[a] for a, _ in pairs], [ids[b] for _, b in pairs], range(len(pairs)),
                          [ids[a + b] for a, b in pairs])
        first = np.array([ids[letters[b]] for b in range(256)], np.int64)
        found = cls(frozenset(), first, table, tuple(t["content"] for t in data.get("added_tokens", ())))
        strings = [(bytes(byte_of[c] for c in s), i) for s, i in ids.items() if all(c in byte_of for c in s)]
        merged = merge_words([first[np.frombuffer(s, np.uint8)] for s, _ in strings], table)
        found.whole = frozenset(s for (s, i), out in zip(strings, merged) if len(out) == 1 and out[0] == i)
        return found

    def count(self, words: list[bytes]) -> list[int]:
        return [len(out) for out in merge_words([self.first[np.frombuffer(w, np.uint8)] for w in words], self.table)]


def token_counter(vocabulary: Vocabulary):
    """A function from a list of texts to their token counts; keeps what it has merged."""
    pre_token = regex.compile(PRE_TOKEN)
    special = regex.compile("|".join(regex.escape(s) for s in vocabulary.special)) if vocabulary.special else None
    costs: dict[str, int] = {}

    def learn(words):
        new = [w for w in words if w not in costs]
        raw = [w.encode() for w in new]
        whole = vocabulary.whole
        rest = [i for i, r in enumerate(raw) if r not in whole]
        costs.update(dict.fromkeys(new, 1))
        costs.update(zip([new[i] for i in rest], vocabulary.count([raw[i] for i in rest])))

    def count(texts: list[str]) -> list[int]:
        if len(costs) > KEPT:
            costs.clear()
        counts, cut = [0] * len(texts), []
        for i, text in enumerate(texts):
            pieces = special.split(text) if special else [text]
            counts[i] = len(pieces) - 1
            for piece in pieces:
                if piece:
                    cut.append((i, pre_token.findall(piece)))
        learn(set().union(*[words for _, words in cut]))
        for i, words in cut:
            counts[i] += sum(map(costs.__getitem__, words))
        return counts

    return count


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[list[str]]:
    """Runs of texts of about `most` characters; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """Every document with `n_bytes`, `n_tokens` and `over_limit`."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))  # bounded by the vocabulary file

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = token_counter(vocabulary.value)
        for batch in batches:
            yield pd.Series([n for run in chunks(batch.fillna("").tolist()) for n in count(run)], dtype="int64")

    kept = [F.col(c) for c in docs.columns if c.lower() not in RESULT]
    whole = F.coalesce(F.col(text), F.lit(""))
    return (docs.select(*kept, F.octet_length(whole).cast("long").alias("n_bytes"), tokens(whole).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
