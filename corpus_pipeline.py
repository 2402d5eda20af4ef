"""From documents to token ids: quality, exact copies, near copies, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet before the
next one reads it.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import bpe, exact_dedup, mixing, quality_classifier, simhash
from vitrina.llm.queries import RANKS
from vitrina.llm.text import prepared, read
from vitrina.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality_classifier.accepted(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    prepared(spark)
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints of three-word shingles that link at two bits): the one with the smallest doc_id."""
    prepared(spark)
    return simhash.near_dedup(docs, shingle=3, distance=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by source weights; a document comes as often, and as far, as it is taken."""
    prepared(spark)
    return mixing.mixed(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of what they decode to."""
    prepared(spark)
    found = bpe.bpe(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixture", mixture),
    ("tokens", tokens),
]

# A trained classifier, near copies and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
