"""Full-refresh sinks, the load manifest and the CSV export."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.dates import parse_timestamp
from vitrina.functions.measures import exact_sum, rows

MANIFEST = "tabla STRING, filas BIGINT"
LOAD_LOG = "tabla STRING, filas BIGINT, claves_nulas BIGINT, importe DOUBLE"
EXPORT_LOG = "tabla STRING, filas BIGINT, error STRING"

# Columns that are read back as dates.
DATE_COLUMNS = [
    "fecha", "fecha_date", "fecha_orden", "fecha_registro", "ultima_compra", "fecha_contratacion", "inicio", "fin",
]


class Written(NamedTuple):
    """What a write measured: rows, rows without a key, and the amount where the table has one."""

    rows: int
    null_keys: int | None
    amount: float | None


def write_measured(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    table: str | None = None,
    bucket_by: tuple[int, str] | None = None,
    key: str | None = None,
    amount: str | None = None,
) -> Written:
    """Replace a table by ``df`` and return what its only job measured on the way.

    The metrics are collected by the tasks that write, so nothing is read again.  ``table``
    registers it in the catalog; ``bucket_by`` then stores it hashed on a
    join key, so that later joins on the key need no shuffle.
    """
    measures = [rows().alias("filas")]
    if key:
        measures.append(F.count(F.when(F.col(key).isNull(), 1)).alias("claves_nulas"))
    if amount:
        measures.append(exact_sum(amount).alias("importe"))
    seen = Observation()
    writer = df.observe(seen, *measures).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)
    found = seen.get
    total = found.get("importe")
    # A plan that Spark knows to be empty measures nothing.
    return Written(found.get("filas", 0), found.get("claves_nulas", 0 if key else None), None if total is None else float(total))


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    table: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> int:
    """``write_measured`` for callers that only want the number of rows."""
    return write_measured(df, path, partition_by, table, bucket_by).rows


def overwrite_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch: int = 10_000) -> None:
    """Replace a database table; partitions insert in parallel, ``batch`` rows at a time."""
    df.write.mode("overwrite").option("batchsize", batch).jdbc(url, table, properties=properties)


def load_tables(spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], root: str) -> DataFrame:
    """Write every table below ``root`` and return the manifest with its total.

    A table given as a function is built when its turn comes, so it may read those written before it.
    """
    written = [(name, overwrite(df() if callable(df) else df, f"{root}/{name}")) for name, df in tables.items()]
    return spark.createDataFrame([*written, ("TOTAL", sum(n for _, n in written))], MANIFEST)


def load_measured(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, amount: str = "subtotal") -> DataFrame:
    """Write every table below ``root``, one job each, and return what the writes measured.

    The key of a table is its first ``id_*`` column; tables without an amount have none.
    """
    log = []
    for name, df in tables.items():
        key = next((c for c in df.columns if c.startswith("id_")), None)
        log.append((name, *write_measured(df, f"{root}/{name}", key=key, amount=amount if amount in df.columns else None)))
    return spark.createDataFrame(log, LOAD_LOG)


def save_all(spark: SparkSession, tables: Mapping[str, DataFrame], database: str, root: str) -> dict[str, int]:
    """Register and write tables in a catalog database of their own; the rows written by table."""
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{root}'")
    return {name: overwrite(df, f"{root}/{name}", table=f"`{database}`.`{name}`") for name, df in tables.items()}


def export_csv(
    spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]], root: str
) -> DataFrame:
    """Write every table as CSV with a header; a table that fails is logged and skipped.

    The rows are counted by the tasks that write, so each table is computed once and need not be stored before.
    """
    log = []
    for name, load in tables.items():
        try:
            seen = Observation()
            counted = load().observe(seen, rows().alias("filas"))
            counted.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{root}/{name}")
            # A plan that Spark knows to be empty measures nothing.
            log.append((name, seen.get.get("filas", 0), None))
        except PySparkException as problem:
            log.append((name, None, problem.getCondition() or type(problem).__name__))
        except Py4JJavaError as problem:  # a task failed, for example on a damaged file
            log.append((name, None, problem.java_exception.getClass().getSimpleName()))
    return spark.createDataFrame(log, EXPORT_LOG)


def coerce_dates(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Parse the known date columns of a text table; bad values become null."""
    return df.withColumns({c: parse_timestamp(c) for c in df.columns if c in columns})


def reread_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """An exported table as text, with its known date columns coerced."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    text = spark.read.schema(schema).options(header=True, escape='"').csv(path)
    return coerce_dates(text)
