"""Readers for operational tables, delimited files and XML documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    location: str,
    schema: str | None = None,
    columns: Sequence[str] | None = None,
    source: str = "parquet",
) -> DataFrame:
    """Full or column-pruned read of a table (``source`` is a file format or ``"catalog"``)."""
    if source == "catalog":
        df = spark.table(location)
    else:
        reader = spark.read.format(source)
        df = (reader.schema(schema) if schema is not None else reader).load(location)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """Read a database table; ``split`` = (column, lower, upper, partitions) reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if split:
        column, lower, upper, partitions = split
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=str(partitions)
        )
    return reader.load()


def read_csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """Delimited text with a header row and a declared schema."""
    settings = {"header": "true", "enforceSchema": "false", "quote": '"', "escape": '"', **options}
    return spark.read.schema(schema).options(**settings).csv(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """One row per ``row_tag`` element; a missing child is null, attribute ``_x`` becomes ``x``."""
    df = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return df.withColumnsRenamed({c: c[1:] for c in df.columns if c.startswith("_")})
