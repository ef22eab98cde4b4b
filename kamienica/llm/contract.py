"""The registered queries of this subpackage and the SQL each must agree with, where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kamienica.contract.registry import table
from kamienica.llm import (chat, collocations, filter_audit, mixing, ngram_lm, packing, quality, sentencepiece_codec, simhash, suffix_dedup, token_counts, topk,
                           url_filter, url_labels)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


@query("op2_mix_sources", mixing.QUERY_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op4_shard_best_fit")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return packing.shard(table(spark, folder, "documents")).select("doc_id", *packing.RESULT)


@query("op6_url_filter")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = url_filter.train(url_labels.labelled_urls(spark))
    return url_filter.judge(pages, model).drop("url")


@query("op9_chat_format", chat.QUERY_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    says = "'</s>[INST] ok [/INST]'"
    added = spark.sql(f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, {says} AS text "
                      f"UNION ALL SELECT -1L, 1L, 'assistant', {says}")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digest(chat.render(chat.fold(chat.log_of(rows))))


@query("op1_quality_rules")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    model, measured = quality.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return quality.judge(measured.withColumnRenamed("__key", "doc_id"), model)


@query("op7_simhash_near_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("__key").alias("doc_id"), "fingerprint", "component_id")


@query("op10_token_counts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@query("op3_suffix_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                    F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_exact_top_k", topk.QUERY_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


@query("op5_sentencepiece")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    both = sentencepiece_codec.encode_and_decode(docs, path, search="viterbi")
    return both.select("doc_id", "n_pieces", F.sha2(F.concat_ws(",", "pieces"), 256).alias("ids_sha256"),
                       F.xxhash64("decoded").alias("decoded_hash"), F.expr("decoded <=> text").alias("round_trip"))


@query("op12_filter_audit", filter_audit.QUERY_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_collocations", collocations.QUERY_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query("op11_lm_scores")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return ngram_lm.score(table(spark, folder, "documents"), held_out)
