"""Recency, frequency and amount per customer: now and as of given dates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.dates import elapsed_days
from vitrina.functions.measures import exact_sum, rows, total
from vitrina.functions.rules import NO_ORDER_RECENCY


def rfm_base(orders: DataFrame) -> DataFrame:
    """Last order, distinct orders, order rows and days since the newest order of all."""
    newest = orders.agg(F.max("fecha_orden")).scalar()
    return (
        orders.where(F.col("id_cliente").isNotNull())
        .groupBy("id_cliente")
        .agg(
            F.max("fecha_orden").alias("ultima_compra"),
            F.countDistinct("id_orden").alias("frecuencia"),
            F.count("id_orden").alias("monetario"),
        )
        .withColumn("recency", elapsed_days("ultima_compra", newest))
    )


def order_amounts(lines: DataFrame) -> DataFrame:
    """Exact amount per order, a decimal; one row per order leaves the line table."""
    return lines.groupBy("id_orden").agg(exact_sum("subtotal").alias("monto"))


def customer_monetary(rfm: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Adds the amount per customer, 0 where no line exists."""
    per_customer = (
        order_amounts(lines)
        .join(orders.select("id_orden", "id_cliente"), "id_orden")
        .groupBy("id_cliente")
        .agg(total("monto").alias("monto_total"))
    )
    return rfm.join(per_customer, "id_cliente", "left").na.fill({"monto_total": 0.0})


def customer_activity(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Everything the customer dimension and the churn features need, in one pass.

    Lines are reduced to one row per order before they meet the orders, orders
    to one row per customer.
    """
    per_order = lines.groupBy("id_orden").agg(
        exact_sum("subtotal").alias("monto"),
        rows().alias("lineas"),
        F.sum(F.col("devuelto").cast("int")).alias("devueltas"),
    )
    newest = orders.agg(F.max("fecha_orden")).scalar()
    return (
        orders.where(F.col("id_cliente").isNotNull())
        .select("id_orden", "id_cliente", "fecha_orden")
        .join(per_order, "id_orden", "left")
        .groupBy("id_cliente")
        .agg(
            F.max("fecha_orden").alias("ultima_compra"),
            F.min("fecha_orden").alias("primera_compra"),
            F.countDistinct("id_orden").alias("frecuencia"),
            F.count("id_orden").alias("monetario"),
            total("monto").alias("monto_total"),
            F.coalesce(F.sum("lineas"), F.lit(0)).alias("lineas"),
            F.coalesce(F.sum("devueltas"), F.lit(0)).alias("devueltas"),
        )
        .withColumn("recency", elapsed_days("ultima_compra", newest))
        .withColumn("antiguedad", elapsed_days("primera_compra", newest))
    )


def half_year_ends(orders: DataFrame, first: date) -> Column:
    """``first`` and the half-year ends after it, up to the first whose midnight sees every order; an array of dates."""
    newest = F.coalesce(F.max("fecha_orden"), F.lit(first).cast("timestamp_ntz")).alias("_ultima")
    half = F.last_day(F.make_date(F.year("_ultima"), F.when(F.month("_ultima") <= 6, 6).otherwise(12), F.lit(1)))
    last = F.when(half.cast("timestamp_ntz") >= F.col("_ultima"), half).otherwise(F.last_day(F.add_months(half, 6)))
    month = 6 if (first.month, first.day) < (6, 30) else 12
    start = F.last_day(F.lit(date(first.year, month, 1)))
    later = F.sequence(start, F.greatest(last, start), F.expr("interval 6 months"))
    ends = F.concat(F.array(F.lit(first)), F.transform(later, lambda day: F.last_day(day)))
    return orders.agg(newest).select(ends).scalar()


def rfm_as_of(customers: DataFrame, orders: DataFrame, lines: DataFrame, cutoffs: Sequence[date] | Column) -> DataFrame:
    """RFM of every customer at midnight of every cutoff date (dates, or an ascending array of them).

    Each order is reduced to its amount and to the first cutoff that sees it, then each
    customer to one row per such cutoff (combined on the map side); running values over
    those rows and one marker per cutoff give the snapshots.  A customer's window has at
    most two rows per cutoff, and the plan is the same for any number of cutoffs.  Repeated
    order rows count once.  Customers without an order up to a cutoff get recency 999 and zeros.
    """
    days = cutoffs if isinstance(cutoffs, Column) else F.array(*map(F.lit, sorted(cutoffs)))
    first = F.size(F.filter("_cortes", lambda day: day.cast("timestamp_ntz") < F.col("fecha_orden")))
    once = (
        orders.where(F.col("id_cliente").isNotNull() & F.col("fecha_orden").isNotNull())
        .withColumn("_cortes", days)
        .select("id_orden", "id_cliente", "fecha_orden", first.alias("corte_n"), F.size("_cortes").alias("_n_cortes"))
        .where(F.col("corte_n") < F.col("_n_cortes"))
        .join(order_amounts(lines), "id_orden", "left")
        .groupBy("id_orden", "id_cliente")
        .agg(F.max("fecha_orden").alias("fecha"), F.max("corte_n").alias("corte_n"), F.max("monto").alias("monto"))
    )
    seen = once.groupBy("id_cliente", "corte_n").agg(
        F.max("fecha").alias("fecha"), rows().alias("n"), F.sum("monto").alias("monto")
    )
    markers = customers.select("id_cliente", F.posexplode(days).alias("corte_n", "corte"))
    until = W.partitionBy("id_cliente").orderBy("corte_n").rangeBetween(W.unboundedPreceding, W.currentRow)
    elapsed = elapsed_days("ultima", F.col("corte").cast("timestamp_ntz"))
    return (
        markers.unionByName(seen, allowMissingColumns=True)
        .select(
            "id_cliente",
            "corte",
            F.max("fecha").over(until).alias("ultima"),
            F.coalesce(F.sum("n").over(until), F.lit(0)).alias("frecuencia"),
            F.coalesce(F.sum("monto").over(until).cast("double"), F.lit(0.0)).alias("monto"),
        )
        .where(F.col("corte").isNotNull())
        .select(
            "id_cliente", "corte", F.coalesce(elapsed, F.lit(NO_ORDER_RECENCY)).alias("recency"), "frecuencia", "monto"
        )
    )


def segment_counts(customers: DataFrame, segment: str = "segmento_rfm") -> DataFrame:
    return customers.groupBy(segment).agg(rows().alias("clientes")).orderBy(F.desc("clientes"), segment)
