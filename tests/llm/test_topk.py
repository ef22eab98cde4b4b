import math
import random

import numpy as np
import pytest

from kamienica.llm import topk


def vectors(n=700, dims=6, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, list(rows[7][1])) for i in range(90)]  # one vector many times
    rows += [(1000, None), (1050, [float("nan")] * dims), (1100, [1.0, None] + [0.0] * (dims - 2)), (1150, [math.inf] * dims),
             (None, [1.0] * dims), (1200, []), (1250, [1.0, 2.0]), (1300, [0.0] * dims), (-50, [2.0] * dims), (1251, [3.0, -1.0])]
    return rows


def brute(rows, every=50, k=5):
    whole = [(i, [math.floor(256 * np.float32(x).item()) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (q, v) in enumerate(whole):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for other, (i, w) in enumerate(whole)
                            if other != own and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("conf", [{}, {"shard_rows": 100, "leaf": 8, "block_queries": 3}])
def test_against_brute_force(spark, conf):
    rows = vectors()
    table = spark.createDataFrame([(*r, "mine", 1) for r in rows], "vec_id long, embedding array<float>, score string, shard int")
    got = topk.top_k(table, **conf).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows)


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(size=(5000, 3)) * 256)
    tree = topk.KDTree(points, np.arange(5000), np.arange(5000), 32)
    for q in points[:40]:
        scores = points @ q
        wanted = sorted((-s, i) for i, s in enumerate(scores) if i != 3)[:5]
        assert tree.top(q, 3, 5, -np.inf) == [(-s, i) for s, i in wanted]
        kth = -wanted[-1][0]
        assert tree.top(q, 3, 5, kth) == [(-s, i) for s, i in wanted]  # a passed-on bound loses no ties
        assert tree.top(q, 3, 5, -wanted[0][0] + 1) == []


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(50, [1.0, 1.0]), (51, [1.0, 0.0]), (100, [0.0, 2.0])], schema)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(few).collect()]
    assert sorted(got) == [(50, 1, 100, 131072), (50, 2, 51, 65536), (100, 1, 50, 131072), (100, 2, 51, 0)]
    assert topk.top_k(few.limit(0)).collect() == []


@pytest.mark.parametrize("conf", [{}, {"shard_rows": 40, "leaf": 8, "block_queries": 2}])
def test_rows_of_one_id_are_queries_and_candidates_of_their_own(spark, conf):
    rng = random.Random(4)
    rows = [(i % 60, [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)]
    rows += [(50, list(rows[3][1])), (50, list(rows[50][1])), (0, list(rows[0][1])), (7, list(rows[0][1]))]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), **conf).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows)
