import re
from collections import defaultdict

from pyspark.sql import functions as F

from kamienica.llm import mixing

from .fixtures import clashing, frame


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, weights, share, most):
    """Targets by handing the excess out again, round after round."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > most * sizes[s] + 1e-9] if total else []
        if not over:
            return full | {s: left * weight[s] / total for s in rest}
        for s in over:
            full[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(full.values())


def test_targets_sizes_and_taken_words(spark):
    docs = frame(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == words(r["text"])
        sizes[r["source"]] += r["size"]
    targets = filled(sizes, (3, 1, 2), 1.5, 2)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - targets[r["source"]]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= largest[source]
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_sampling_follows_the_order_of_odds(spark):
    rows = [(i, "w " * (1 + i % 5), "en", "a" if i % 3 else "b", 1) for i in range(600)]
    out = [r.asDict() for r in mixing.mix(frame(spark, rows)).withColumn(
        "u", mixing.uniform(F.col("doc_id").cast("string"), 7)).collect()]
    for source in "ab":
        own = [r for r in out if r["source"] == source]
        whole = int(own[0]["target"] // own[0]["source_size"])
        drawn = sorted((r["u"] for r in own if r["copies"] > whole))
        missed = sorted((r["u"] for r in own if r["copies"] == whole))
        if drawn and missed:  # all drawn ones come first, but for the one that closes the gap
            assert drawn[-2] < missed[0]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1


def test_preference_raises_the_odds(spark):
    rows = [(i, "w w w", "en", f"s{i % 3}", 1) for i in range(900)]
    out = mixing.mix(frame(spark, rows), preference=F.when(F.col("doc_id") < 450, 3.0).otherwise(1.0)).groupBy(
        F.col("doc_id") < 450).agg(F.avg("copies").alias("n")).collect()
    mean = {r[0]: r["n"] for r in out}
    assert mean[True] > 1.3 * mean[False]


def test_empty_and_clashing(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    got = mixing.mix(clashing(frame(spark), mixing.RESULT + ("u", "tie", "rank"))).select("doc_id", "u", *mixing.RESULT)
    plain = mixing.mix(frame(spark)).select("doc_id", F.lit("mine").alias("u"), *mixing.RESULT)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_only_words_missing(spark):
    rows = [(1, None, None, "a", 1), (2, "", None, None, 1)]
    assert {(r["doc_id"], r["taken"], r["target"]) for r in mixing.mix(frame(spark, rows)).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}
