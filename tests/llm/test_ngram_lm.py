import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kamienica.llm import ngram_lm
from kamienica.llm.elias_fano import Sequence64, Trie
from tests.llm.fixtures import clashing, documents, frame

def held():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]  # None is the end


def brute(rows, order, kappa):
    out_of = [key is not None and zlib.crc32(str(key).encode()) % 7 == 2 for key, *_ in rows]
    texts = [tokens_of(text) for _, text, *_ in rows]
    counts, contexts = Counter(), Counter()
    for t, out in zip(texts, out_of):
        if not out:
            padded = [None, *t]
            for j in range(1, len(padded)):
                for n in range(1, order + 1):
                    if j - n + 1 >= 0:
                        gram = tuple(padded[j - n + 1:j + 1])
                        counts[gram] += 1
                        contexts[gram[:-1]] += 1
    n_tokens, kinds = sum(len(t) for t, out in zip(texts, out_of) if not out), len([g for g in counts if len(g) == 1])

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 1) / (n_tokens + kinds + 1)
        return (counts[gram] + kappa * p(gram[1:])) / (contexts[gram[:-1]] + kappa)

    found = []
    for (key, *_), t, out in zip(rows, texts, out_of):
        padded = [None, *t]
        base = sum(math.log10(p((w,))) for w in t)
        best = sum(math.log10(p(tuple(padded[max(0, j - order + 1):j + 1]))) for j in range(1, len(padded)))
        found.append((key, out, len(t), sum(counts[w,] > 0 for w in t), n_tokens, base, best))
    return found


def check(got, want, slack):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got.collect()), key=order), sorted(want, key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9, abs=1e-9)
    for g, w in zip(got, want):
        assert abs(g[6] - w[6]) <= slack * w[2] + 1e-6, (g, w)


@pytest.mark.parametrize("order, shard_size", [(2, 10 ** 6), (3, 400)])
def test_equals_a_plain_model(spark, order, shard_size):
    rows = documents()
    df = clashing(frame(spark, rows), ["block", "shard", "score", "held", "key"]).repartition(3)
    check(ngram_lm.score(df, held(), order, 5.0, shard_size=shard_size), brute(rows, order, 5.0), 0.02)


def small(n=40):
    return [(i, "the cat " * (i % 4) + "sat on a mat, " + "x" * (i % 3), None, None, None) for i in range(n)]


@pytest.mark.parametrize("order", [2, 3])
def test_few_probabilities_are_exact(spark, order):
    check(ngram_lm.score(frame(spark, small()), held(), order, 2.0), brute(small(), order, 2.0), 1e-6)


def test_awkward_tables(spark):
    assert ngram_lm.score(frame(spark, []), held()).count() == 0
    rows = [(None, None, None, None, None), (1, "", None, None, None), (1, " \n", None, None, None), (2, "A a A", None, None, 1)]
    check(ngram_lm.score(frame(spark, rows), held()), brute(rows, 2, ngram_lm.KAPPA), 1e-6)
    rows = [(key, "only held out", None, None, None) for key in range(60) if zlib.crc32(str(key).encode()) % 7 == 2]
    assert {r["score"] for r in ngram_lm.score(frame(spark, rows), held()).collect()} == {0.0}


def test_many_shards(spark):
    rows = [(i, " ".join(f"hot w{(i * 37 + j * 11) % 90}" for j in range(50)), None, None, None) for i in range(60)]
    got = ngram_lm.score(frame(spark, rows), held(), 2, 3.0, shard_size=50)
    check(got, brute(rows, 2, 3.0), 0.02)


def test_spread_rows_by_successor():
    level = ngram_lm.Level(None, np.array([1, 1, 2]), np.array([1, 2, 3]), None, np.array([10, 11, 12], np.uint64))
    block = ngram_lm.Block.__new__(ngram_lm.Block)
    block.shards = [1, 7]
    below = ngram_lm.Level(None, None, np.arange(3), None, np.array([4, 5, 6], np.uint64), None,
                           np.array([0, ngram_lm.HOT + 1, 3]))
    block.levels = [below]
    order, shard = block.dealt(level, 2)
    assert dict(zip(order.tolist(), shard.tolist())) == {0: 10 % 7, 1: 11 % 7, 2: 6}


def test_better_than_single_words_on_held_out_texts(spark):
    got = ngram_lm.score(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), held())
    out = got.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert out[1] > out[0]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2 ** 45)), st.lists(st.integers(0, 2 ** 46), max_size=30))
def test_sequences(values, asked):
    values = np.sort(np.array(values, np.uint64))
    sequence = Sequence64.of(values)
    assert (sequence.get(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, np.array(asked, np.uint64)])
    rng = np.random.default_rng(len(values))
    ends = np.sort(rng.integers(0, len(values) + 1, (len(asked), 2)), axis=1)
    got = sequence.successor(asked, ends[:, 0], ends[:, 1])
    assert (got == np.clip(np.searchsorted(values, asked), ends[:, 0], ends[:, 1])).all()


@pytest.mark.parametrize("order", [2, 3, 4])
def test_tries(order, tmp_path):
    rng = np.random.default_rng(order)
    grams = np.unique(rng.integers(0, 40, (3000, order)) ** 2, axis=0)
    trie = Trie.of(grams, 2000)
    place = {tuple(g): i for i, g in enumerate(grams.tolist())}
    asked = np.concatenate([grams, rng.integers(0, 40, (3000, order)) ** 2])
    want = [place.get(tuple(g), -1) for g in asked.tolist()]
    trie.write(tmp_path / "trie")
    for t in (trie, trie.mapped(tmp_path / "trie")):
        assert t.find(asked).tolist() == want
    plain = grams.size * 8
    assert os.path.getsize(tmp_path / "trie") < plain


def test_steps():
    rng = np.random.default_rng(1)
    logs, counts = rng.normal(-4, 1, 10_000), rng.integers(1, 50, 10_000)
    logs[7], counts[7] = -0.01, 200_000
    means, step = ngram_lm.quantised(logs, counts)
    assert len(means) <= 255 and np.abs(means[step - 1] - logs).mean() < 0.03 and means[step[7] - 1] == pytest.approx(-0.01)
    assert abs((counts * means[step - 1]).sum() / (counts * logs).sum() - 1) < 1e-6
    few, step = ngram_lm.quantised(np.array([-1.0, -2.0, -1.0]), np.array([1, 1, 5]))
    assert few[step - 1].tolist() == [-1.0, -2.0, -1.0]
