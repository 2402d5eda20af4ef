"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import (
    bpe,
    divergence,
    exact_dedup,
    html_extract,
    importance,
    line_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
)
from vitrina.llm.text import read

RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, folder, "documents"))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.scores(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, folder, "documents"))


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(read(spark, folder, "pages"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(read(spark, folder, "documents"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    # On its own the query has room for more units than as a stage of the pipeline.
    found = bpe.bpe(read(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, remembered=600_000)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.classes(read(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.dedup(read(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


_ALL = [
    op1_line_dedup,
    op2_quality_classifier,
    op3_quality_rules,
    op4_html_extraction,
    op5_mixing,
    op6_simhash,
    op7_sharding,
    op8_byte_bpe,
    op9_exact_dedup,
    op10_token_counts,
    op11_suffix_dedup,
    op12_importance,
    op13_divergence,
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {query.__name__: query for query in _ALL}

# The others have no SQL: models, byte-pair merges and components are tested against brute force.
ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.oracle(),
    "op3_quality_rules": quality_rules.oracle(),
    "op5_mixing": mixing.oracle(),
    "op7_sharding": sharding.oracle(),
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op11_suffix_dedup": suffix_dedup.oracle(),
    "op12_importance": importance.oracle(),
    "op13_divergence": divergence.oracle(),
}
