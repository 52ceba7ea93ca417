"""The operators over the given tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import aurum
from aurum.llm import (ann, bpe_replay, dual_tree, kneser_ney, line_quality, main_text, minhash, mixing, suffix_dedup, token_binary,
                       toxicity, turn_trie, warc)
from aurum.llm.common import table


def ready(spark: SparkSession) -> None:
    """Workers import the package from where the driver has it, unless they are told otherwise."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(aurum.__file__))))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents")).drop("text")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe_replay.bpe_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "source", "lang", "topic", "tokens", "factor", "probability", "sampled")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return token_binary.roundtrip(table(spark, sf_dir, "documents"), f.read())


def op8_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_digests(table(spark, sf_dir, "documents"))


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.code_digests(table(spark, sf_dir, "embeddings"))


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.trie(table(spark, sf_dir, "conversations"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"))


def prepared(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return f(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: prepared(f) for f in (
    op1_toxicity, op2_line_quality, op3_bpe, op4_kneser_ney, op5_mixing, op6_warc, op7_token_binary,
    op8_learned_partitions, op9_suffix_dedup, op10_probminhash, op11_dual_tree,
    op12_turn_trie, op13_main_text)}
