"""Shared definitions: words, lower case, and the plumbing of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.session import configure

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# The characters that do not belong to words, as a list for trim.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of text that one Arrow batch may hold, so that long texts do not add up.
BATCH_BYTES = "33554432"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the options that the operators rely on."""
    configure(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, BATCH_BYTES)
    return spark


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def texts(batch: pa.RecordBatch, column: str | int) -> Iterator[bytes]:
    """The texts of a batch as UTF-8, one at a time; null counts as empty."""
    for value in batch.column(column).cast(pa.large_binary()):
        yield b"" if (raw := value.as_py()) is None else raw
