"""The eight dimensions of the star schema.

Lookups are plain joins: Spark broadcasts a side by its own size check and
otherwise shuffles, with AQE splitting hot keys.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.dates import season, weekday
from vitrina.functions.measures import margin_pct
from vitrina.functions.rules import DIMENSION_RULE, NO_ORDER_RECENCY, SegmentRule, rfm_segment
from vitrina.operators.keys import dense_keys
from vitrina.operators.rfm import customer_activity


def calendar_dim(facts: DataFrame, moment: str) -> DataFrame:
    """One row per day between the first and the last fact.

    At most one row per calendar day, so the frame is small whatever the facts
    are, and the day number is its key.
    """
    span = facts.agg(F.min(moment).alias("lo"), F.max(moment).alias("hi"))
    days = span.select(F.posexplode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("pos", "fecha"))
    return days.select(
        (F.col("pos") + 1).cast("long").alias("id_tiempo"),
        "fecha",
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        F.date_format("fecha", "MMMM").alias("nombre_mes"),
        F.quarter("fecha").alias("trimestre"),
        F.weekofyear("fecha").alias("semana"),
        weekday("fecha").alias("dia_semana"),
        F.date_format("fecha", "EEEE").alias("nombre_dia"),
        (weekday("fecha") >= 5).alias("es_fin_semana"),
        season(F.month("fecha")).alias("estacion"),
        F.col("fecha").alias("fecha_date"),
    )


def product_dim(products: DataFrame, categories: DataFrame, suppliers: DataFrame) -> DataFrame:
    named = products.withColumnsRenamed({"nombre": "nombre_producto"})
    category = categories.select("id_categoria", F.col("nombre").alias("nombre_categoria"))
    supplier = suppliers.select("id_proveedor", F.col("nombre").alias("nombre_proveedor"))
    return (
        named.join(category, "id_categoria")
        .join(supplier, "id_proveedor")
        .select(
            "id_producto",
            "nombre_producto",
            "id_categoria",
            "nombre_categoria",
            "id_proveedor",
            "nombre_proveedor",
            "precio_unitario",
            "costo_unitario",
            "activo",
            margin_pct("precio_unitario", "costo_unitario").alias("margen_pct"),
        )
    )


def _with_city(df: DataFrame, cities: DataFrame, name: str) -> DataFrame:
    return df.withColumnRenamed("nombre", name).join(
        cities.withColumnRenamed("nombre", "nombre_ciudad"), "id_ciudad"
    )


def customer_dim(
    customers: DataFrame,
    cities: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    rule: SegmentRule = DIMENSION_RULE,
) -> DataFrame:
    """Customer and city attributes with recency, frequency, amount and segment."""
    rfm = customer_activity(orders, lines).select(
        "id_cliente", "ultima_compra", "frecuencia", "monetario", "recency", "monto_total"
    )
    return (
        _with_city(customers, cities, "nombre_cliente")
        .join(rfm, "id_cliente", "left")
        .na.fill({"recency": NO_ORDER_RECENCY, "frecuencia": 0, "monto_total": 0})
        .withColumn("monto_total", F.col("monto_total").cast("long"))
        .withColumn("segmento_rfm", rfm_segment("recency", "frecuencia", "monto_total", rule))
    )


def store_dim(stores: DataFrame, cities: DataFrame) -> DataFrame:
    return _with_city(stores, cities, "nombre_tienda").select(
        "id_tienda", "nombre_tienda", "id_ciudad", "tipo", "tamano_m2", "nombre_ciudad", "region", "zona"
    )


def employee_dim(employees: DataFrame, stores: DataFrame, how: str = "inner") -> DataFrame:
    """``how="left"`` keeps employees whose store is unknown."""
    names = stores.select("id_tienda", F.col("nombre").alias("nombre_tienda"))
    return (
        employees.withColumnRenamed("nombre", "nombre_empleado")
        .join(names, "id_tienda", how)
        .select(
            "id_empleado", "nombre_empleado", "cargo", "id_tienda", "fecha_contratacion", "salario", "nombre_tienda"
        )
    )


def payment_dim(methods: DataFrame) -> DataFrame:
    return methods.select("id_metodo_pago", "nombre", "comision_pct")


def supplier_dim(internal: DataFrame, external: DataFrame) -> DataFrame:
    """Both supplier sources in one shape, internal ones first."""
    own = internal.select(
        F.col("id_proveedor").alias("id_proveedor_origen"), "nombre", "pais", F.lit("Interno").alias("tipo")
    )
    other = external.select(
        F.col("id_proveedor_ext").alias("id_proveedor_origen"),
        F.col("nombre_empresa").alias("nombre"),
        "pais",
        F.lit("Externo").alias("tipo"),
    )
    union = own.unionByName(other)
    return dense_keys(union, [F.col("tipo").desc(), "id_proveedor_origen"], "id_proveedor_dw")


def campaign_dim(campaigns: DataFrame) -> DataFrame:
    return dense_keys(campaigns, ["id"], "id_campana_dw")


def with_audit_date(dimension: DataFrame, columns: list[str], updated: date) -> DataFrame:
    """Type 1 dimension: the current attributes and the date of the load."""
    return dimension.select(*columns, F.lit(updated).alias("ultima_actualizacion"))
