"""From raw documents to packed training sequences: five stages, each one of the operators in factweave/llm.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a frame that is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``:

1. quality: the byte-level network, learned from ``labels``, rejects documents (they go).
2. near_dedup: one document of each SimHash component stays (4-word shingles, at most 4 differing bits).
3. secrets: spans of secrets, base and linked, are replaced by a mark.
4. mixing: documents leave or are copied, whole, so that every source comes near its target.
5. packing: the texts become padded sequences of at most 2048 tokens; one row per piece, with its ids.

The tokenizer and the learned network have no SQL equivalent, so ``ORACLE_SQL`` is None; the tests compare
every stage with a brute-force version.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from factweave.llm import mixing, packing, quality, secret_scan, simhash
from factweave.llm.common import shared_dir, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs, shingle=4, radius=4)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, whole_texts=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=2048, end_id=1,
                        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder before the next begins."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
