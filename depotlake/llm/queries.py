"""Each operator over its whole table, as a named query."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.llm import alignment, bpe, exact, fingerprints, infill, licenses, mixing, near, packing, passages, pii, secrets, toxicity
from depotlake.llm.tables import Query, documents

#: Only for this query; a real corpus has a secret key.
PII_KEY = b"key of the registered query"


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_documents(documents(spark, folder))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.token_files(documents(spark, folder), path, public_tokenizers.PATTERN, end_id=2)


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near.near_duplicates(documents(spark, folder), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, folder), carry=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_digests(documents(spark, folder), ranks, public_tokenizers.PATTERN)


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.fingerprint_documents(documents(spark, folder))
    shown = {name: F.lower(F.hex(name)) for name in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(shown)


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.exact_duplicates(documents(spark, folder))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = passages.without_repeats(documents(spark, folder))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op10_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replace_private(documents(spark, folder), PII_KEY)


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(documents(spark, folder), *paths, public_tokenizers.PATTERN)


def op12_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_labels(licenses.find_licenses(documents(spark, folder)))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = infill.fill_in_middle(documents(spark, folder))
    text = infill.restored(made["output"], made["form"])
    return made.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_token_files": op2_token_files,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_fingerprints": op6_fingerprints,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_license_scans": op12_license_scans,
    "op13_fill_in_middle": op13_fill_in_middle,
}
