import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from kamienica.llm import filter_audit
from tests.llm.fixtures import clashing, documents, frame

FLAGS = [lambda t, w: len(w) < 50, lambda t, w: 100 * len(set(w)) < 65 * len(w),
         lambda t, w: 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), lambda t, w: bool(re.search(r"[#$%&*|]", t))]
LABELS = [(i, i % 2, int(i % 5 == 0)) for i in range(1, 40)] + [(3, 0, 1), (None, 1, 1), (5, None, None)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute(rows, marks):
    """Every document walked through every order."""
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, t in marks if t == 1 and i is not None}
    failed = []
    for key, text, _, source, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        ids = [i for i, t, *_ in rows if (t or "") == text and i is not None]
        last = bool(ids) and (key is None or key > min(ids))
        failed.append((source or "", key, {c for c, bad in zip("ABCDE", [*(f(text, words) for f in FLAGS), last]) if bad}))
    want, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {p for p, *_ in failed}:
            left = [(k, bad) for p, k, bad in failed if p == part]
            everyone = left
            for step, c in enumerate(order, 1):
                gone = [k for k, bad in left if c in bad]
                left = [(k, bad) for k, bad in left if c not in bad]
                shapley[part, c] += len(gone)
                want[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in bad for _, bad in everyone) - len(gone),
                    sum(bad == {c} for _, bad in everyone), sum(k in good for k in gone), sum(k in toxic for k in gone)]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in want.items()}


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


def test_equals_walking_every_order(spark):
    rows = documents()
    got = filter_audit.audit_documents(clashing(frame(spark, rows), ["part", "mask", "kept", "digest", "alone"]), labels(spark))
    assert got.columns == [c.split()[0] for c in filter_audit.RESULT.split(", ")]
    assert found(got) == brute(rows, LABELS)


def test_intervals_cover_every_order_once():
    for mask in range(1, 32):
        ranks = sorted(r for _, a, z in filter_audit.INTERVALS[mask] for r in range(a, z))
        assert ranks == list(range(120))
        for step, a, z in filter_audit.INTERVALS[mask]:
            for order in filter_audit.ORDERS[a:z]:
                assert [i for i in order if mask >> i & 1][0] == order[step]
    assert filter_audit.NAMES == sorted(filter_audit.NAMES) and len(set(filter_audit.NAMES)) == 120


def test_awkward_tables(spark):
    assert filter_audit.audit_documents(frame(spark, []), labels(spark)).count() == 0
    nulls = [(None, None, None, None, None), (None, "", None, None, None), (4, "", None, "", 1), (4, "", None, "", 1)]
    got = found(filter_audit.audit_documents(frame(spark, nulls), labels(spark, [])))
    assert got == brute(nulls, [])
    one = found(filter_audit.audit_documents(frame(spark, [(None, "a b", None, None, None)] * 3), labels(spark)))
    assert one["", "ABCDE", 1][:2] == (0, 3) and one["", "EABCD", 1][1] == 0


def test_hot_text_and_many_parts(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"), (F.col("id") % 700).cast("string").alias("source"))
    got = filter_audit.audit_documents(docs, labels(spark))
    assert got.count() == 700 * 600
    assert got.where("filter_order = 'EABCD' and step = 1").agg(F.sum("removed")).first()[0] == 999
    assert got.where("filter_order = 'ABCDE' and step = 5").agg(F.sum("kept"), F.sum("redundant")).first() == (0, 999)
