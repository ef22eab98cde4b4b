"""How five document filters interact: what every order of applying them removes at every step.

A document is reduced to the mask of the filters it fails, and the corpus to counts by part and mask. In one order a document
goes at the first filter of the order that it fails. For a mask, a filter f of it and a step, the orders in which f takes the
document there are those that begin with other letters and then f; orders with a common beginning are neighbours when all
orders are listed by their Lehmer rank. So a mask adds its counts at both ends of a few intervals of ranks, and one prefix
sum over the ranks gives what is removed at every step of every order.

Filters (words are maximal runs of anything but blanks and \\t to \\r): A has under 50 words; B has 100 * distinct words
< 65 * words; C has 100 * capitals A-Z > 5 * characters; D holds one of #$%&*|; E equals the text of a smaller id.

Defined cases: a null text is empty (it fails A, and E behind another empty text); a null id counts as greater than all ids
and has no label; rows with one id are rows of their own, and none of them fails E because of the other; several labels
of an id count as one that has what any of them has; a null part is the empty string; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kamienica.session import settle

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5  # words, percent of words, percent of characters
SYMBOLS, CAPITALS, INNER = b"#$%&*|", bytes(range(65, 91)), bytes(range(0x80, 0xC0))
COUNTS = ("docs", "good", "toxic")
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def failed_alone(raw: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return ((len(words) < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
            | (100 * capitals > MOST_CAPITALS * len(raw.translate(None, INNER))) << 2
            | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3)


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, mask) of every document, written.

    The least id of each text is found by digest. Whether a row has it is asked by digest and id together, so that a text
    with any number of copies is no hot key.
    """
    @F.pandas_udf("int")
    def failed(texts: pd.Series) -> pd.Series:
        return pd.Series([failed_alone(raw) for raw in texts], dtype=np.int32)

    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = settle(docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                              F.unhex(F.sha2(raw, 256)).alias("digest"), failed(raw).alias("alone")))
    first = slim.groupBy(F.col("digest").alias("same")).agg(F.min("id").alias("least"))
    met = slim.join(first, (slim["digest"] == first["same"]) & slim["id"].eqNullSafe(first["least"]), "left")
    return met.select("id", "part", (F.col("alone") + F.when(F.col("same").isNull(), 16).otherwise(0)).alias("mask"))


def mask_counts(masked: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, mask, docs, good, toxic): at most 32 rows a part."""
    def has(column: str):
        return F.max(F.coalesce(F.col(column) == 1, F.lit(False)).cast("long"))

    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("labelled")).agg(
        has("quality").alias("good"), has("toxic").alias("toxic"))
    joined = masked.join(known, masked["id"] == known["labelled"], "left")
    return joined.groupBy("part", "mask").agg(F.count("*").alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                                              F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def intervals(mask: int, n: int = len(FILTERS)) -> list[tuple[int, int, int]]:
    """(step from 0, first rank, rank behind the last) for all beginnings of orders that end with the removal."""
    harmless = [i for i in range(n) if not mask >> i & 1]
    found = []
    for step in range(len(harmless) + 1):
        for before in permutations(harmless, step):
            for taker in (i for i in range(n) if mask >> i & 1):
                rank, left = 0, list(range(n))
                for at, letter in enumerate((*before, taker)):
                    rank += left.index(letter) * factorial(n - 1 - at)
                    left.remove(letter)
                found.append((step, rank, rank + factorial(n - 1 - step)))
    return found


ORDERS = np.array(list(permutations(range(len(FILTERS)))))  # by rank
NAMES = ["".join(FILTERS[i] for i in order) for order in ORDERS]
INTERVALS = {mask: intervals(mask) for mask in range(1, 2 ** len(FILTERS))}


def totals(rows: dict[int, np.ndarray]) -> dict[str, np.ndarray]:
    """What happens at (rank, step), from (docs, good, toxic) by mask."""
    n = len(FILTERS)
    ends = np.zeros((len(ORDERS) + 1, n, len(COUNTS)), np.int64)
    fails, alone, every = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for mask, counts in rows.items():
        every += counts[0]
        for i in range(n):
            fails[i] += counts[0] * (mask >> i & 1)
            alone[i] += counts[0] * (mask == 1 << i)
        for step, first, behind in INTERVALS.get(mask, ()):
            ends[first, step] += counts
            ends[behind, step] -= counts
    lost = ends.cumsum(axis=0)[:-1]
    removed = lost[:, :, 0]
    shares = np.array([removed[ORDERS == i].sum() for i in range(n)], np.int64)
    return {"kept": every - removed.cumsum(axis=1), "removed": removed, "redundant": fails[ORDERS] - removed,
            "unique_fails": alone[ORDERS], "good_lost": lost[:, :, 1], "toxic_lost": lost[:, :, 2],
            "shapley": shares[ORDERS]}


def _part(table: pa.Table) -> pa.Table:
    counts = np.column_stack([table.column(c).to_numpy() for c in COUNTS]).astype(np.int64)
    found = totals(dict(zip(table.column("mask").to_pylist(), counts)))
    n = len(FILTERS)
    columns = {"part": pa.array([table.column("part")[0].as_py()] * (len(ORDERS) * n), pa.string()),
               "filter_order": pa.array(np.repeat(NAMES, n).tolist(), pa.string()),
               "step": pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(ORDERS)))}
    return pa.table({**columns, **{name: pa.array(values.ravel()) for name, values in found.items()}})


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order and step; a part is at most 32 rows of `counts`."""
    return counts.groupBy("part").applyInArrow(_part, RESULT)


def audit_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    part: str = "source") -> DataFrame:
    return audit(mask_counts(masks(docs, key, text, part), labels, key))


QUERY_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part,
    (len(words) < 50)::INT AS a, (100 * len(list_distinct(words)) < 65 * len(words))::INT AS b,
    (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t))::INT AS c,
    regexp_matches(t, '[#$%&*|]')::INT AS d, (least IS NOT NULL AND doc_id IS DISTINCT FROM least)::INT AS e FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, [a, b, c, d, e] AS fails, count(*) AS docs, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
i AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [p.i, q.i, r.i, s.i, u.i] AS o FROM i p, i q, i r, i s, i u
    WHERE len(list_distinct([p.i, q.i, r.i, s.i, u.i])) = 5),
x AS (SELECT part, o, k.i AS step, o[k.i] AS filter, docs, good, toxic, fails[o[k.i]] AS fails_it,
        list_sum(fails) = 1 AS once, coalesce(list_sum([fails[y] FOR y IN o[1:k.i - 1]]), 0) AS before FROM m, o, i k),
y AS (SELECT part, o, step, filter,
        coalesce(sum(docs) FILTER (before = 0 AND fails_it = 0), 0)::BIGINT AS kept,
        coalesce(sum(docs) FILTER (before = 0 AND fails_it = 1), 0)::BIGINT AS removed,
        coalesce(sum(docs) FILTER (before > 0 AND fails_it = 1), 0)::BIGINT AS redundant,
        coalesce(sum(docs) FILTER (once AND fails_it = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (before = 0 AND fails_it = 1), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (before = 0 AND fails_it = 1), 0)::BIGINT AS toxic_lost FROM x GROUP BY ALL)
SELECT part, array_to_string([substr('ABCDE', z, 1) FOR z IN o], '') AS filter_order, step::INTEGER AS step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM y
"""
