import re
from collections import Counter

import numpy as np

from kamienica.llm import quality

from .fixtures import clashing, documents, frame, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(inside))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_and_base_rules(spark):
    docs = frame(spark)
    model, measured = quality.fit(docs, labels(spark, []))
    rows = quality.judge(quality.measure(docs), model).collect()
    assert len(rows) == len(documents()) == measured.count()
    for r in rows:
        wanted = brute(r["text"])
        assert tuple(r[c] for c in quality.COUNTS) == wanted
        assert r["base_failed"] == (wanted[0] < 50 or 100 * wanted[4] > 50 * wanted[0])
        assert r["kept"] == (not r["base_failed"])  # without labels nothing else rejects


def test_held_out_junk_is_found_and_clean_documents_stay(spark):
    import random
    rng = random.Random(9)
    clean = [(i, prose(rng, 150), "en", "a", 1) for i in range(400)]
    junk = [(1000 + i, (prose(rng, 150).upper() if i % 2 else " ".join(w + "$$%" for w in prose(rng, 150).split())), "en", "a", 1)
            for i in range(40)]
    docs = frame(spark, clean + junk)
    known = [(i, 1, 0) for i in range(0, 400, 2)] + [(1000 + i, 0, 0) for i in range(20)]
    model, _ = quality.fit(docs, labels(spark, known + [(None, 1, 0), (5, None, 0), (77777, 1, 1)]))
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(quality.measure(docs), model).collect()}
    assert np.mean([kept[i] for i in range(1, 400, 2)]) > 0.97
    assert np.mean([kept[1020 + i] for i in range(20)]) < 0.1


def test_forest_scores_outliers_higher_and_is_repeatable():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(size=(2000, 3)), [[9, 9, 9], [-8, 8, 0]]])
    forest = quality.Forest.grow(rows, 64, 256)
    score = forest.score(rows)
    assert score[-2:].min() > np.quantile(score[:2000], 0.999)
    assert np.array_equal(score, quality.Forest.grow(rows, 64, 256).score(rows))
    same = quality.Forest.grow(np.ones((5, 3)), 8, 256).score(np.ones((2, 3)))
    assert np.isfinite(same).all()


def test_calibration():
    good, bad = np.array([50, 40, 9, 1, 0, 0.]), np.array([0, 0, 5, 3, 2, 0.])
    assert quality.calibrate(good, bad, 0.02) == 3
    assert quality.calibrate(good, bad, 0.0) == 4
    assert quality.calibrate(good, bad, 0.2) == 2
    assert quality.calibrate(0 * good, bad, 0.02) == 6


def test_empty_and_clashing(spark):
    model, _ = quality.fit(frame(spark, []), labels(spark, [(1, 1, 0)]))
    assert quality.judge(quality.measure(frame(spark, [])), model).collect() == []
    docs = clashing(frame(spark), quality.RESULT)
    model, _ = quality.fit(docs, labels(spark, [(i, 1, 0) for i in range(20)]))
    assert {r["base_failed"] for r in quality.judge(quality.measure(docs), model).collect()} == {True, False}
