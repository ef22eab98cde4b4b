import re

import corpus_pipeline as pipeline
import public_tokenizers
import pytest

from .fixtures import documents, frame
from .test_simhash import brute_components, brute_print
from .test_suffix_dedup import brute as brute_suffix
from .test_tokens import best_sum_library, piece_scores, same_by_word

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before and after each stage, each written and read again."""
    folder = tmp_path_factory.mktemp("tables")
    frame(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 20)] + [(40, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((docs, after))
        docs = after
    return str(folder), dict(zip([n for n, _ in pipeline.STAGES], out))


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(steps):
    for name, (_, after) in list(steps[1].items())[:-1]:
        assert after.columns == COLUMNS, name


def test_quality_keeps_clean_and_drops_junk(steps):
    kept = rows(steps[1]["quality_rules"][1])
    assert {i for i, _ in kept} >= set(range(1, 25)) and not {35, 36, 37, 38, 39, 42} & {i for i, _ in kept}
    repeated = sum(1 for r in documents() if r[0] == documents()[2][0])
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= 50 for _, t in kept) and repeated


def test_one_of_each_near_copy_stays(steps):
    before, after = map(rows, steps[1]["simhash_near_dedup"])
    roots = brute_components([brute_print(t) for _, t in before])
    least = {}
    for (i, t), root in zip(before, roots):
        least[root] = min(least.get(root, (True, 0, "")), (i is None, i or 0, t))
    assert sorted((i or 0, t) for i, t in after) == sorted((i, t) for _, i, t in least.values())


def test_repeats_are_cut(steps):
    before, after = steps[1]["suffix_array_dedup"]
    wanted = brute_suffix(rows(before))
    assert sorted(t for _, t in rows(after)) == sorted(k[4].decode(errors="ignore") for k in wanted if not k[2] or k[4])
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_mix_takes_whole_copies(steps):
    before, after = map(rows, steps[1]["mix_sources"])
    assert set(after) <= set(before) and all(after.count(r) <= 2 * before.count(r) for r in set(after))
    sizes = [len(t.split()) for _, t in before]
    assert abs(sum(len(t.split()) for _, t in after) - 1.5 * sum(sizes)) <= max(sizes)  # documents are taken whole


def test_encoded_texts_are_those_of_the_mix(steps):
    before, after = steps[1]["sentencepiece"]
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert sorted(rows(before), key=repr) == sorted(rows(after), key=repr)
    library, score = best_sum_library(path), piece_scores(path)
    for r in after.collect():
        assert r["round_trip"] and same_by_word(r["pieces"], library, r["text"], score)


def test_run_applies_all_stages(spark, steps):
    got = pipeline.run(spark, steps[0])
    assert sorted(rows(got), key=repr) == sorted(rows(steps[1]["sentencepiece"][1]), key=repr)
