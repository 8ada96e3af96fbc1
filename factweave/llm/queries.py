"""Registered queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import chat, embedding_dedup, runs, substrings, topk
from factweave.llm.bin_slack import pack_min_slack
from factweave.llm.common import table
from factweave.llm.mixing import mix_sizes
from factweave.llm.packing import pack
from factweave.llm.quality import quality_scores
from factweave.llm.secret_scan import secret_scan
from factweave.llm.simhash import simhash_components
from factweave.llm.token_counts import token_counts
from factweave.llm.whitening import whiten


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), window=50)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=2048, end_id=1,
                ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(chat.format_chats(rows.unionByName(chat.control_conversation(spark))))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_min_slack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=4096, end_id=1)


def planted_period(doc_id: int | None, words: list) -> list:
    """The contract's rewrite of a tenth of the documents: from a word on, a stretch of p words repeats to the end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.periodic_runs(table(spark, sf_dir, "documents"), min_length=24, prepare=planted_period))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a sum beyond 64 bits (some million vectors) leaves ``deviation`` null; the operator's own column is a decimal
    return whiten(table(spark, sf_dir, "embeddings"), components=8).withColumn("deviation", F.expr("try_cast(deviation AS long)"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_top_k": op2_top_k,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_min_bin_slack": op11_min_bin_slack,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}
SQL: dict[str, str] = {"op2_top_k": topk.SQL, "op3_substring_dedup": substrings.SQL, "op7_embedding_dedup": embedding_dedup.SQL,
                       "op8_chat_formatting": chat.SQL}


def registered() -> tuple[dict, dict]:
    """(queries, SQL) to register."""
    import corpus_pipeline
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, SQL | sql
