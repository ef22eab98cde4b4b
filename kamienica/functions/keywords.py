"""Keyword rules by the thousand: one automaton over all keywords, one pass over each text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rules = Iterable[tuple[Iterable[str], str]]


class Automaton:
    """Keywords of the rules of several columns with goto and failure links. A text is read once, and every column gets the
    value of its first rule that has a keyword in the text; an empty keyword is in every text."""

    def __init__(self, rules: Mapping[str, list[tuple[list[str], str]]]):
        import ahocorasick

        self.columns = list(rules)
        self.values = [[value for _, value in own] for own in rules.values()]
        self.always: dict[int, int] = {}
        ranks: dict[str, dict[int, int]] = {}  # keyword -> column -> first rule
        for column, own in enumerate(rules.values()):
            for rank, (keywords, _) in enumerate(own):
                for keyword in keywords:
                    if keyword:
                        ranks.setdefault(keyword, {}).setdefault(column, rank)
                    else:
                        self.always.setdefault(column, rank)
        self.machine = ahocorasick.Automaton() if ranks else None
        for keyword, found in ranks.items():
            self.machine.add_word(keyword, tuple(found.items()))
        if ranks:
            self.machine.make_automaton()

    def values_of(self, text: str | None) -> list[str | None]:
        if text is None:
            return [None] * len(self.columns)
        best = dict(self.always)
        for _, hits in self.machine.iter(text) if self.machine is not None else ():
            for column, rank in hits:
                if rank < best.get(column, rank + 1):
                    best[column] = rank
        return [own[best[c]] if c in best else None for c, own in enumerate(self.values)]


def keyword_values(text: Column, rules: Mapping[str, Rules]) -> Column:
    """A struct with a field for each column of `rules`: the value of its first rule that matches `text`, else null.

    The rules travel with the task and become an automaton once in it; texts pass in Arrow batches.
    """
    held = {c: [(list(keywords), value) for keywords, value in own] for c, own in rules.items()}
    schema = T.StructType([T.StructField(f"v{i}", T.StringType()) for i in range(len(held))])

    @F.pandas_udf(schema)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(held)
        for batch in batches:
            yield pd.DataFrame([automaton.values_of(t) for t in batch], columns=schema.names, dtype=object)

    return find(text)
