"""Quality rules with an isolation forest on their statistics.

Every text is measured once (words, symbols, repeated lines and word triples, capitals). The fixed base rules reject some
documents. The rest is judged by an isolation forest: trees of random splits over bounded samples; a document that needs
few splits to be told apart is anomalous. The threshold is calibrated from counts of all labelled rows by score: of the
thresholds above which at most `loss` of the labelled good documents lie, the one with the least cost, a lost good
document costing WORTH times as much as a bad one that stays (as shares of either label).

Defined cases: a null or empty text has no words and fails the base rules; without labelled good rows nothing but the
base rules rejects; rows equal in text are judged alike; documents without a label only take part as documents; an empty
table gives an empty result; input columns with the names of result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kamienica.session import settle

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "threshold", "kept")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_capitals", "n_chars"]
MEASURES = COUNTS + EXTRA
TREES, SAMPLE = 128, 256  # trees, and rows each of them is grown from
WORTH = 5
BINS = 4000  # steps of the score between 0 and 1 in which labelled rows are counted
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS, CAPITALS = b"#*$%&|<>", bytes(range(65, 91))
INNER = bytes(range(0x80, 0xC0))  # bytes within a code point


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)
    _, window, counts = np.unique(pair[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    often = counts[window] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift:shift + n] |= often
    return int(inside.sum())


def measure_text(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words, lines = raw.split(), raw.split(b"\n")
    seen, repeats = set(), 0
    for line in lines:
        if line.strip():
            repeats += line in seen
            seen.add(line)

    def share(letters):
        return len(raw) - len(raw.translate(None, letters))

    return (len(words), len(raw.translate(None, SPACE + INNER)), share(SYMBOLS), repeats, repeated_words(words),
            share(CAPITALS), len(text))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the struct `__measures`; other columns are passed by Python."""
    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def measures(texts: pd.Series) -> pd.DataFrame:
        rows = [measure_text(t) for t in texts]
        return pd.DataFrame(np.array(rows, np.int64).reshape(-1, len(MEASURES)), columns=MEASURES)

    return docs.withColumn("__measures", measures(F.coalesce(F.col(text), F.lit(""))))


def base_failed(measures: Column) -> Column:
    return (measures["n_words"] < 50) | (100 * measures["n_repeat_words"] > 50 * measures["n_words"])


def features(m: pd.DataFrame) -> np.ndarray:
    """Letters per word, symbols per word, capitals per character: what tells junk apart once the base rules have dealt with
    short and repeating texts. Digits and other marks, which personal data and lists bring, say nothing about quality."""
    words = np.maximum(m.n_words, 1)
    return np.column_stack([m.word_chars / words, m.n_symbols / words, m.n_capitals / np.maximum(m.n_chars, 1)]).astype(float)


def mean_path(n) -> np.ndarray:
    """Mean splits needed to find nothing among n random values."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays of shape (trees, nodes); a leaf points to itself and holds the whole length of its path."""
    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray  # left child; right is the next node
    path: np.ndarray
    depth: int
    usual: float

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 11) -> Forest:
        rng = np.random.default_rng(seed)
        sample = min(sample, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
        size = 2 ** (depth + 1)
        feature, child = np.zeros((trees, size), np.int64), np.tile(np.arange(size), (trees, 1))
        split, path = np.full((trees, size), np.inf), np.zeros((trees, size))
        for t in range(trees):
            waiting, free = [(0, rows[rng.choice(len(rows), sample, replace=False)], 0)], 1
            while waiting:
                node, part, level = waiting.pop()
                low, high = part.min(axis=0), part.max(axis=0)
                wide = np.flatnonzero(high > low)
                if level == depth or len(part) < 2 or not len(wide):
                    path[t, node] = level + mean_path(len(part))
                    continue
                f = rng.choice(wide)
                at = rng.uniform(low[f], high[f])
                left = part[:, f] <= at
                feature[t, node], split[t, node], child[t, node] = f, at, free
                waiting += [(free, part[left], level + 1), (free + 1, part[~left], level + 1)]
                free += 2
        return cls(feature, split, child, path, depth, float(mean_path(sample)) or 1.0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the more anomalous."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, split, child, path in zip(self.feature, self.split, self.child, self.path):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                down = child[node]
                node = np.where(down == node, node, down + (rows[every, feature[node]] > split[node]))
            total += path[node]
        return 2.0 ** (-total / (len(self.feature) * self.usual))


def calibrate(good: np.ndarray, bad: np.ndarray, loss: float) -> int:
    """The bin from which on documents are rejected, by counts of labelled documents in each bin of the score."""
    if not good.sum():
        return len(good)
    lost = good[::-1].cumsum()[::-1] / good.sum()
    left = 1 - bad[::-1].cumsum()[::-1] / max(bad.sum(), 1)
    cost = np.where(lost <= loss, WORTH * lost + left, np.inf)
    return int(len(cost) - 1 - cost[::-1].argmin())


@dataclass
class QualityModel:
    forest: Forest | None
    threshold: float


def with_score(measured: DataFrame, forest: Forest | None) -> DataFrame:
    if forest is None:
        return measured.withColumn("__score", F.lit(0.0))
    shared = measured.sparkSession.sparkContext.broadcast(forest)  # trees * 512 nodes, whatever the input

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for m in batches:
            yield pd.Series(shared.value.score(features(m)))

    return measured.withColumn("__score", score("__measures"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", loss: float = 0.01,
        trees: int = TREES, sample: int = SAMPLE) -> tuple[QualityModel, DataFrame]:
    """The model, and the written table (key, __measures) it was fitted on."""
    measured = settle(measure(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text")
                      .select("__key", "__measures"))
    return fit_measured(measured, labels, "__key", loss, trees, sample)


def fit_measured(measured: DataFrame, labels: DataFrame, key: str = "doc_id", loss: float = 0.01, trees: int = TREES,
                 sample: int = SAMPLE) -> tuple[QualityModel, DataFrame]:
    """The model for rows with `__measures`, best a written table as it is read twice, and its (key, __measures).

    The forest is grown from the `trees` * `sample` documents that pass the base rules and have the lowest hashes; all
    labelled documents count for the threshold.
    """
    measured = measured.select(F.col(key).alias("__key"), "__measures")
    passing = measured.where(~base_failed(F.col("__measures")))
    rows = (passing.orderBy(F.xxhash64("__key", *[F.col(f"__measures.{m}") for m in MEASURES])).limit(trees * sample)
            .select("__measures.*").toPandas())
    if not len(rows):
        return QualityModel(None, 1.0), measured
    forest = Forest.grow(features(rows), trees, sample)
    named = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("__key"), "quality")
    counts = (with_score(passing.join(named, "__key"), forest)
              .groupBy(F.floor(F.col("__score") * BINS).cast("int").alias("bin"), "quality").count().toPandas())
    by_bin = np.zeros((2, BINS + 2))
    np.add.at(by_bin, (counts["quality"].astype(int), counts["bin"].astype(int)), counts["count"])
    threshold = calibrate(by_bin[1], by_bin[0], loss) / BINS
    return QualityModel(forest, threshold), measured


def judge(measured: DataFrame, model: QualityModel) -> DataFrame:
    """Adds the base counts, `base_failed`, `score`, `threshold` and `kept` to rows with `__measures`."""
    others = [c for c in measured.columns if c.lower() not in RESULT and c != "__measures"]
    m = F.col("__measures")
    failed = base_failed(m)
    return with_score(measured, model.forest).select(
        *others, *[m[c].alias(c) for c in COUNTS], failed.alias("base_failed"), F.col("__score").alias("score"),
        F.lit(model.threshold).alias("threshold"), (~failed & (F.col("__score") < model.threshold)).alias("kept"))
