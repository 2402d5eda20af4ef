"""Weekly sales and additive seasonal decomposition for any number of series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.dates import week_ending
from vitrina.functions.measures import total

WEEKS = 52


def weekly_sales(fact: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Sales and distinct orders per week ending on Sunday; empty weeks are kept with 0."""
    sold = (
        fact.where(F.col("fecha_orden").isNotNull())
        .groupBy(*series, week_ending("fecha_orden").alias("semana_fin"))
        .agg(total("subtotal").alias("ventas"), F.countDistinct("id_orden").alias("transacciones"))
    )
    # Every week is repeated up to the one before the next week with sales; the repeats count 0.
    one = W.partitionBy(*series)
    before_next = F.date_sub(F.lead("semana_fin").over(one.orderBy("semana_fin")), 7)
    weeks = F.sequence("semana_fin", F.coalesce("_hasta", "semana_fin"), F.expr("INTERVAL 7 DAYS"))
    real = F.col("_salto") == 0
    return (
        sold.withColumn("_hasta", before_next)
        .withColumn("_inicio", F.min("semana_fin").over(one))
        .select(*series, "_inicio", "ventas", "transacciones", F.posexplode(weeks).alias("_salto", "semana_fin"))
        .select(
            *series,
            F.floor(F.datediff("semana_fin", "_inicio") / 7).cast("int").alias("i"),
            "semana_fin",
            F.when(real, F.col("ventas")).otherwise(0.0).alias("ventas"),
            F.when(real, F.col("transacciones")).otherwise(0).alias("transacciones"),
        )
    )


def _centered_mean(value: str, period: int, series: W, position: str, length: Column) -> Column:
    """Centered moving average; an even period gives the outermost two points half weight."""
    half = period // 2
    around = series.rowsBetween(-half, half)
    if period % 2:
        smooth = F.avg(value).over(around)
    else:
        ends = F.lag(value, half).over(series) + F.lead(value, half).over(series)
        smooth = (F.sum(value).over(around) - ends / 2) / period
    inside = (F.col(position) >= half) & (F.col(position) < length - half)
    return F.when(inside, smooth)


def seasonal_decompose(
    weekly: DataFrame, series: Sequence[str] = (), value: str = "ventas", period: int = WEEKS
) -> DataFrame:
    """Observed = trend + seasonal + residual, per series.

    Expects the dense grid of ``weekly_sales`` with its position ``i``.  A series
    is as long as the calendar has weeks, so one window partition per series is
    small; the work spreads over the series.
    """
    one = W.partitionBy(*series)
    ordered = one.orderBy("i")
    length = F.count(F.lit(1)).over(one)
    message = F.concat(F.lit(f"a series needs at least {2 * period} points, found "), F.col("_n").cast("string"))
    long_enough = F.when(F.col("_n") < 2 * period, F.raise_error(message).cast("double")).otherwise(F.col(value))
    phase = W.partitionBy(*series, "_fase")
    return (
        weekly.withColumn("_n", length)
        .withColumn("observado", long_enough)
        .withColumn("_fase", F.col("i") % period)
        .withColumn("tendencia", _centered_mean("observado", period, ordered, "i", F.col("_n")))
        .withColumn("_sin", F.col("observado") - F.col("tendencia"))
        .withColumn("_media", F.avg("_sin").over(phase))
        .withColumn("_peso", F.count(F.lit(1)).over(phase))
        # Each phase counts once in the level, however often it occurs.
        .withColumn("_nivel", F.sum(F.col("_media") / F.col("_peso")).over(one) / period)
        .withColumn("estacional", F.col("_media") - F.col("_nivel"))
        .withColumn("residuo", F.col("_sin") - F.col("estacional"))
        .select(*series, "i", "semana_fin", "observado", "tendencia", "estacional", "residuo")
    )
