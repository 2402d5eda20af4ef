"""Roll-up, slice, dice, drill-down and pivot over a star."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.dates import MONTH_NAMES, period_label
from vitrina.functions.measures import millions, rows, total


def _sales() -> Column:
    return total("subtotal").alias("ventas")


def _units() -> Column:
    return F.sum("cantidad").alias("cantidad")


def rollup(star: DataFrame, levels: Sequence[str] = ("anio", "trimestre", "mes", "nombre_mes")) -> DataFrame:
    """Sales, units and distinct orders at the leaf of a hierarchy."""
    return star.groupBy(*levels).agg(_sales(), _units(), F.countDistinct("id_orden").alias("transacciones"))


def monthly_series(rolled: DataFrame) -> DataFrame:
    """The roll-up summed to months, with a ``yyyy-MM`` label."""
    months = rolled.groupBy("anio", "mes", "nombre_mes").agg(total("ventas").alias("ventas"))
    return months.withColumn("periodo", period_label("anio", "mes")).withColumn("ventas_mm", millions("ventas"))


def slice_(star: DataFrame, dimension: str, value: object) -> DataFrame:
    """One member of one dimension, by year."""
    out = star.where(F.col(dimension) == value).groupBy("anio").agg(_sales(), _units())
    return out.withColumn("ventas_mm", millions("ventas"))


def dice(star: DataFrame, members: dict[str, object]) -> DataFrame:
    """One member of several dimensions, by month."""
    hit = reduce(lambda a, b: a & b, (F.col(c) == v for c, v in members.items()))
    return star.where(hit).groupBy("nombre_mes").agg(_sales(), _units())


def drilldown(star: DataFrame, dimension: str, value: object, months: Sequence[str] = MONTH_NAMES) -> DataFrame:
    """One member by (year, quarter) with a whole-number column per month."""
    cells = (
        star.where(F.col(dimension) == value)
        .groupBy("anio", "trimestre")
        .pivot("nombre_mes", list(months))
        .agg(total("subtotal"))
    )
    return cells.select("anio", "trimestre", *[F.coalesce(F.col(m).cast("long"), F.lit(0)).alias(m) for m in months])


def pivot(star: DataFrame, rows_by: str = "nombre_categoria", quarters: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """Members by quarter, in millions, empty cells 0."""
    cells = star.groupBy(rows_by).pivot("trimestre", list(quarters)).agg(total("subtotal"))
    return cells.select(
        rows_by, *[millions(F.coalesce(F.col(str(q)), F.lit(0.0))).alias(f"trimestre_{q}") for q in quarters]
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def sales_by(star: DataFrame, *keys: str) -> DataFrame:
    """Dashboard visual: sales, units and lines by any attributes."""
    return star.groupBy(*keys).agg(_sales(), _units(), rows().alias("lineas"))


def top_by_sales(star: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The n best sellers; ties are resolved by the keys."""
    return star.groupBy(*keys).agg(_sales(), _units()).orderBy(F.desc("ventas"), *keys).limit(n)
