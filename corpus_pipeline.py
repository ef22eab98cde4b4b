"""The training-data pipeline: rule out bad documents, keep one of each near-duplicate group, cut repeated passages, mix
the sources, encode.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kamienica.llm import mixing, quality, sentencepiece_codec, simhash, suffix_dedup
from kamienica.session import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    measured = settle(quality.measure(docs))  # written once, so that no text is measured again for the verdict
    model, _ = quality.fit_measured(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(measured, model).where("kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document has; n_chars follows. A document of which nothing is left goes."""
    cut = suffix_dedup.dedup_text(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    mixed = mixing.mix(docs)
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        *docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with piece ids (the best sum of scores), their number, and whether they decode to the text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.encode_and_decode(docs, path, search="viterbi").withColumn("round_trip", F.expr("decoded <=> text")).drop("decoded")


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup),
          ("suffix_array_dedup", suffix_array_dedup), ("mix_sources", mix_sources), ("sentencepiece", sentencepiece)]

#: A forest, linked fingerprints and merges are not to be had in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
