"""The queries opN_<name>: each applies its operator to its whole table and returns the contract's columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, huffman, licenses, lm, near, packing, pivots, repeats, rules, windows
from .chunks import vocabulary
from .common import shared_folder, table


def _hex(column: str):
    return F.lower(F.hex(column)).alias("kept_sha256")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_k(table(spark, sf_dir, "embeddings"))


def op3_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op5_superkmer_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.remove_repeated_windows(table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", _hex("kept"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_suffix_array_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", _hex("kept"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    huffman.write_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return huffman.read_files(spark, path)


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_pivot_top_k,
        op3_ppm_score,
        op4_setsketch_near_duplicates,
        op5_superkmer_windows,
        op6_best_fit_packing,
        op7_suffix_array_repeats,
        op8_license_scan,
        op9_quality_rules,
        op10_token_files,
    )
}
#: None of the ten can be said in SQL that ends on whole tables; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {}
