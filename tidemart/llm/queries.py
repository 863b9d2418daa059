"""The registered queries of this package: one per operator, over the whole of its table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import bpe_tree, collocations, exact_dedup, langid, licenses, line_dedup, minhash, mixing, packing
from tidemart.llm import periodic_runs, rules, token_counts, toxicity
from tidemart.llm.common import crc_bucket, documents


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summarise(line_dedup.mark_lines(documents(spark, sf_dir)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ledger(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes("base")).alias("base_failed"), rules.passes(rules.CURRENT).alias("kept"),
        "n_lines", "failed_bits",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_bucket("doc_id", 3) == 1
    found = langid.identify(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), percent=85)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = crc_bucket("doc_id", 5) == 0
    found = toxicity.score_documents(docs, toxicity.fit(docs, labels, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_tree.encode_documents(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return bpe_tree.decode_documents(encoded, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir), least=100, longest=5).top(2000)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets 1 to 8 fill the model's tables, bucket 9 trains its weights, bucket 0 is held out."""
    docs, bucket = documents(spark, sf_dir), crc_bucket("doc_id", 10)
    model, counts = mixing.fit(docs, bucket != 0, bucket == 9)
    return mixing.score(docs, model, counts).select(
        "doc_id", (bucket == 0).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "total_bits", "n_bytes", "bits_per_byte",
    )


def repeat_tail(doc: int | None, words: list[bytes]) -> list[bytes]:
    """The words that op13 searches: a tenth of the documents repeats a block of its own from some word on.

    Documents without an id are searched as they are.
    """
    h = zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    block = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (block * (1 + (n - a) // len(block)))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(documents(spark, sf_dir), shortest=6, times=4, rewrite=repeat_tail)
    best = periodic_runs.strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.listing(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_quality_rules,
        op3_language_id,
        op4_minhash_near_dedup,
        op5_toxicity,
        op6_exact_dedup,
        op7_best_fit_packing,
        op8_bpe_tree,
        op9_license_scan,
        op10_token_counts,
        op11_phrase_collocations,
        op12_lm_scoring,
        op13_periodic_runs,
    )
}
