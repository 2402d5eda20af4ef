"""Row counts, schema listing and referential integrity."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.measures import rows


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_counts(tables: Mapping[str, DataFrame], total_label: str | None = None) -> DataFrame:
    """Rows per table as one job; optionally with the sum of all tables."""
    counts = union_all([df.agg(F.lit(name).alias("tabla"), rows().alias("filas")) for name, df in tables.items()])
    if total_label is None:
        return counts
    return (
        counts.rollup("tabla")
        .agg(F.sum("filas").alias("filas"))
        .withColumn("tabla", F.coalesce("tabla", F.lit(total_label)))
    )


def primary_key(columns: list[str]) -> str | None:
    """By convention the first ``id_*`` column."""
    return next((c for c in columns if c.startswith("id_")), None)


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """Base tables of a catalog database (no temporary views)."""
    listed = spark.catalog.listTables(database)
    return {t.name: spark.table(f"{database}.{t.name}" if database else t.name) for t in listed if not t.isTemporary}


def catalog_listing(spark: SparkSession, database: str, counts: Mapping[str, int]) -> DataFrame:
    """Ordered columns of the saved tables of a database, with comment, key flag and rows.

    Read from the catalog; views and temporary views are no base tables and are left out.
    """
    listing = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary or table.tableType == "VIEW":
            continue
        columns = [(c.name, c.description) for c in spark.catalog.listColumns(f"`{database}`.`{table.name}`")]
        key = primary_key([name for name, _ in columns])
        rows_ = next((n for name, n in counts.items() if name.lower() == table.name.lower()), None)
        listing += [(table.name, i, name, note, name == key, rows_) for i, (name, note) in enumerate(columns, 1)]
    return spark.createDataFrame(listing, "tabla STRING, posicion INT, columna STRING, comentario STRING, es_pk BOOLEAN, filas BIGINT")


def commented(df: DataFrame, notes: Mapping[str, str]) -> DataFrame:
    """The frame with comments on some columns, which a saved table keeps."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": notes[c]}) if c in notes else F.col(c) for c in df.columns])


def selected[T](
    tables: Mapping[str, T], include: Collection[str] | None = None, exclude_prefixes: Sequence[str] = ()
) -> dict[str, T]:
    """The tables of the ``include`` list, all without one, less those whose name begins with a prefix."""
    return {
        name: table
        for name, table in tables.items()
        if (include is None or name in include) and not name.startswith(tuple(exclude_prefixes))
    }


def schema_listing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Ordered columns of every table with the key flag and the size of the table."""
    spark = next(iter(tables.values())).sparkSession
    listing = [
        (name, position, column, column == primary_key(df.columns))
        for name, df in tables.items()
        for position, column in enumerate(df.columns, 1)
    ]
    columns = spark.createDataFrame(listing, "tabla STRING, posicion INT, columna STRING, es_pk BOOLEAN")
    return columns.join(table_counts(tables), "tabla")


def inferred_relations(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(table, column, referenced table): a column named like another table's key is a foreign key."""
    owner = {primary_key(df.columns): name for name, df in tables.items() if primary_key(df.columns)}
    return [
        (name, column, owner[column])
        for name, df in tables.items()
        for column in df.columns
        if column in owner and column != primary_key(df.columns) and owner[column] != name
    ]


def fk_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per inferred relation whose key is missing in the referenced table.

    Keys are counted before the join, so a key that fills a table is compared once.
    """
    checks = []
    for name, column, target in inferred_relations(tables):
        used = tables[name].where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("_n"))
        known = tables[target].select(column)
        missing = used.join(known, column, "left_anti")
        checks.append(
            missing.agg(
                F.lit(name).alias("tabla"),
                F.lit(column).alias("columna"),
                F.lit(target).alias("referencia"),
                F.coalesce(F.sum("_n"), F.lit(0)).alias("huerfanos"),
            )
        )
    return union_all(checks)
