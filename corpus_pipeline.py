"""From raw documents to packed sequences: each stage works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import exact_dedup, langid, minhash, packing, toxicity
from tidemart.llm.common import crc_bucket, documents, prepare, staged

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents it gets, but for those that the query op3 holds out."""
    prepare(spark)
    return langid.keep_identified(docs, langid.fit(docs, crc_bucket("doc_id", 3) != 1))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the documents it gets, but for those that the query op5 holds out."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels, crc_bucket("doc_id", 5) != 0))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.keep_one_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles and a similarity of 0.8 or more; one document of each group stays."""
    prepare(spark)
    return minhash.keep_one_each(docs, percent=80)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", drop_unidentified),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: SQL can express neither the learned stages nor packing; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
