"""Growth and margin indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import (
    cost_hundredfold,
    exact_sum,
    growth_pct,
    half_even,
    millions,
    percent,
    ratio,
    total,
    total_cost,
    total_hundredth,
)
from vitrina.functions.rules import growth_band, margin_band


def totals(star: DataFrame) -> DataFrame:
    """One row: sales, distinct orders and products, first and last year."""
    return star.agg(
        total("subtotal").alias("ventas_totales"),
        F.countDistinct("id_orden").alias("transacciones"),
        F.countDistinct("id_producto").alias("productos"),
        F.min("anio").alias("anio_min"),
        F.max("anio").alias("anio_max"),
    )


def yoy(star: DataFrame) -> DataFrame:
    """Sales per year and growth over the previous year present in the data."""
    years = star.groupBy("anio").agg(
        total("subtotal").alias("ventas"), F.countDistinct("id_orden").alias("ordenes")
    )
    # One row per year reaches this window.
    before = F.lag("ventas").over(W.orderBy("anio"))
    return (
        years.withColumn("ventas_mm", millions("ventas"))
        .withColumn("crecimiento_yoy_pct", growth_pct("ventas", before))
        .withColumn("banda", growth_band("crecimiento_yoy_pct"))
    )


def yoy_same_period(star: DataFrame) -> DataFrame:
    """Sales per month against the same month one calendar year before."""
    months = star.groupBy("anio", "mes").agg(total("subtotal").alias("ventas"))
    last_year = months.select((F.col("anio") + 1).alias("anio"), "mes", F.col("ventas").alias("ventas_previas"))
    return months.join(last_year, ["anio", "mes"], "left").withColumn(
        "crecimiento", ratio(F.col("ventas") - F.col("ventas_previas"), "ventas_previas")
    )


def margin_by_category(star: DataFrame) -> DataFrame:
    """Revenue, estimated cost and three views of the margin per category."""
    return (
        star.groupBy("nombre_categoria")
        .agg(
            total("subtotal").alias("ingresos"),
            total_cost("subtotal", "margen_pct").alias("costo_estimado"),
            F.avg("margen_pct").alias("margen_promedio"),
            F.sum("cantidad").alias("unidades"),
        )
        .withColumn(
            "margen_real_pct", half_even(percent(F.col("ingresos") - F.col("costo_estimado"), "ingresos"), 1)
        )
        .withColumn("banda", margin_band("margen_real_pct"))
    )


def summary(yearly: DataFrame, margins: DataFrame) -> DataFrame:
    """One row: mean growth, mean margin, best and worst category with their margins."""
    # Ties go to the first name, so the answer does not depend on row order.
    ranked = margins.select("nombre_categoria", "margen_real_pct")
    best = F.min(F.struct((-F.col("margen_real_pct")).alias("negado"), "nombre_categoria"))
    worst = F.min(F.struct("margen_real_pct", "nombre_categoria"))
    growth = yearly.agg(half_even(F.avg("crecimiento_yoy_pct"), 4)).scalar()
    return (
        ranked.agg(
            half_even(F.avg("margen_real_pct"), 4).alias("margen_medio_pct"),
            best.alias("_mejor"),
            worst.alias("_peor"),
        )
        .select(
            growth.alias("crecimiento_medio_pct"),
            "margen_medio_pct",
            F.col("_mejor.nombre_categoria").alias("mejor_categoria"),
            (-F.col("_mejor.negado")).alias("mejor_margen_pct"),
            F.col("_peor.nombre_categoria").alias("peor_categoria"),
            F.col("_peor.margen_real_pct").alias("peor_margen_pct"),
        )
    )


def year_category_sums(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Decimal sums per year and category from one join; ``fact`` has the year.

    Lines of unknown products keep their year, and are marked, because they count in
    the growth but in no margin.
    """
    known = products.select("id_producto", "nombre_categoria", "margen_pct", F.lit(True).alias("conocido"))
    joined = fact.join(known, "id_producto", "left")
    return joined.groupBy("anio", "nombre_categoria", "conocido").agg(
        exact_sum("subtotal").alias("ventas"),
        exact_sum(cost_hundredfold("subtotal", "margen_pct")).alias("costo_centuplo"),
    )


def summary_of_sums(sums: DataFrame) -> DataFrame:
    """``summary`` from the sums per year and category, which should be stored."""
    yearly = sums.groupBy("anio").agg(total("ventas").alias("ventas"))
    # One row per year reaches this window.
    before = F.lag("ventas").over(W.orderBy("anio"))
    yearly = yearly.select(growth_pct("ventas", before).alias("crecimiento_yoy_pct"))
    margins = sums.where("conocido").groupBy("nombre_categoria")
    margins = margins.agg(total("ventas").alias("ingresos"), total_hundredth("costo_centuplo").alias("costo_estimado"))
    real = half_even(percent(F.col("ingresos") - F.col("costo_estimado"), "ingresos"), 1)
    return summary(yearly, margins.withColumn("margen_real_pct", real))


def bi_measures(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Dashboard cards: sales, distinct orders and the mean margin of the product dimension."""
    return fact.agg(
        total("subtotal").alias("total_ventas"), F.countDistinct("id_orden").alias("transacciones")
    ).withColumn("margen_promedio", products.agg(F.avg("margen_pct")).scalar())
