"""Monthly sales per category and their Pearson correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import exact_sum, total

TOTAL = "total_ventas"


def monthly_matrix(star: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Months by category, empty cells 0, with the row total."""
    cells = star.groupBy("anio", "mes").pivot("nombre_categoria", list(categories)).agg(total("subtotal"))
    filled = cells.select("anio", "mes", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in categories])
    # Column by column from left to right, so the total does not depend on the plan.
    summed = F.lit(0.0)
    for c in categories:
        summed = summed + F.col(f"`{c}`")
    return filled.withColumn(TOTAL, summed)


def monthly_sales(star: DataFrame) -> DataFrame:
    """(anio, mes, columna, suma): exact sales per month and category."""
    keys = ["anio", "mes", F.col("nombre_categoria").alias("columna")]
    return star.groupBy(*keys).agg(exact_sum("subtotal").alias("suma"))


def monthly_cells(sold: DataFrame, categories: DataFrame) -> DataFrame:
    """(anio, mes, columna, ventas): the matrix in long form, empty cells 0, with the total of each month.

    ``sold`` is read several times, so it should be a stored table; ``categories`` has one
    row per ``nombre``.  The list of months is bounded by the calendar.
    """
    months = sold.agg(F.collect_set(F.struct("anio", "mes"))).scalar()
    empty = categories.select(F.col("nombre").alias("columna"), F.inline(months)).select("anio", "mes", "columna")
    named = empty.join(sold, ["anio", "mes", "columna"], "left")
    totals = sold.groupBy("anio", "mes").agg(F.lit(TOTAL).alias("columna"), F.sum("suma").alias("suma"))
    return named.unionByName(totals).select(
        "anio", "mes", "columna", F.coalesce(F.col("suma").cast("double"), F.lit(0.0)).alias("ventas")
    )


def correlation_matrix(cells: DataFrame) -> DataFrame:
    """Lower triangle with diagonal in long form; null where a column is constant.

    Columns meet month by month; moments combine before they are shuffled by pair.
    """
    # A constant column has no correlation, not even with itself.  A window holds the months of a column.
    column = W.partitionBy("columna")
    cells = cells.withColumn("varia", F.min("ventas").over(column) < F.max("ventas").over(column))
    left = cells.select("anio", "mes", F.col("columna").alias("a"), F.col("ventas").alias("x"), F.col("varia").alias("va"))
    right = cells.select("anio", "mes", F.col("columna").alias("b"), F.col("ventas").alias("y"), F.col("varia").alias("vb"))
    pairs = left.join(right, ["anio", "mes"]).where(F.col("a") <= F.col("b"))
    both = F.col("va") & F.col("vb")
    found = F.corr(F.when(both, F.col("x")), F.when(both, F.col("y")))
    return pairs.groupBy("a", "b").agg(found.alias("correlacion"))


def top_correlations(pairs: DataFrame, with_column: str = TOTAL, n: int = 5) -> DataFrame:
    """Columns most correlated with one column, itself excluded."""
    other = F.when(F.col("a") == with_column, F.col("b")).otherwise(F.col("a"))
    return (
        pairs.where(((F.col("a") == with_column) | (F.col("b") == with_column)) & (F.col("a") != F.col("b")))
        .select(other.alias("columna"), "correlacion")
        .orderBy(F.desc("correlacion"), "columna")
        .limit(n)
    )
