"""From raw documents to token ids: five stages over the whole corpus.

Each stage works on what its predecessor kept, written as Parquet and read again.  All but the last
return the columns of ``documents``.

Defined cases: a null text is a clean document without words, stays, and is encoded as no ids; rows with a null
doc_id stay; rows that repeat a doc_id and text count once from the second stage on; a document of which the
passage stage leaves nothing stays with an empty text; other columns are dropped, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aurum.llm import bpe_replay, minhash, mixing, suffix_dedup, toxicity
from aurum.llm.common import table, written
from aurum.llm.queries import ready

#: A repeated passage has this many bytes or more: passages of a little over 50 words may be shorter than 300 bytes.
PASSAGE_BYTES = 250

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    ready(spark)
    docs = docs.select(*COLUMNS)
    return toxicity.reject_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ready(spark)
    return minhash.one_of_each(docs.select(*COLUMNS))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without the passages of PASSAGE_BYTES or more that occur elsewhere too."""
    ready(spark)
    return suffix_dedup.without_repeats(docs.select(*COLUMNS), PASSAGE_BYTES)


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target weights of sources, languages and topics."""
    return mixing.sample(docs.select(*COLUMNS))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, and the digests of ids and decoded bytes."""
    ready(spark)
    ranks = bpe_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe_replay.bpe_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("suffix_dedup", without_repeated_passages),
    ("mixing", mixed_to_targets),
    ("bpe", encoded),
]

#: Learned scores, hashes and arithmetic coding have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
