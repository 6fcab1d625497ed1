"""A corpus from raw documents to token ids: filter, two deduplications, mixing, tokens.

Each stage is (name, function), and a function takes (spark, docs, sf_dir) and gives a DataFrame.
``run`` writes each stage's rows to the shared folder as Parquet and reads them again, so a lost
executor costs running tasks only. All stages but the last keep the columns of documents. Stages with
Python workers lower the session's limit of rows in an Arrow batch to BATCH_ROWS.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from depotlake.llm import bpe, exact, mixing, near, toxicity
from depotlake.llm.tables import Scratch, documents, limit_batches


#: Bytes that a worker remembers in the last stage. Its workers serve the other stages, too.
ENCODER_MEMORY = 24 << 20
#: Rows that an executor and a worker hold at once. With Spark's 10,000 they hold whole files of texts.
BATCH_ROWS = 1000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine trained on labels does not reject."""
    limit_batches(spark, BATCH_ROWS)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of those with equal texts, by white space normalised."""
    return exact.drop_exact_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words and a similarity of 0.8 or more."""
    limit_batches(spark, BATCH_ROWS)
    return near.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document that the mix has, once for each time."""
    limit_batches(spark, BATCH_ROWS)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_digests(docs, ranks, public_tokenizers.PATTERN, memory=ENCODER_MEMORY)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("source_mixing", mixing_stage),
    ("byte_bpe", byte_bpe_stage),
]

#: SQL cannot express the trained filter and the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return docs
