"""Slowly changing dimensions of type 2.

Two modes: ``strict=False`` gives the open-ended validity columns of the
existing warehouse (a current product row starts at the default date, replaced
customer versions keep the open end); ``strict=True`` gives intervals that
follow each other without overlap.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import guarded_margin_pct, rows
from vitrina.functions.rules import SNAPSHOT_RULE, SegmentRule, rfm_segment
from vitrina.operators.joins import NEXT, ROWS, change_arrays, latest_by, next_start
from vitrina.operators.keys import dense_keys
from vitrina.operators.rfm import rfm_as_of

# First load date and the end date of an open version.
FIRST_DAY = date(2023, 1, 1)
OPEN_END = date(9999, 12, 31)


def price_current(products: DataFrame, history: DataFrame) -> DataFrame:
    """Price and cost now: the latest change, or the list price without any change."""
    latest = latest_by(history, "id_producto", ["fecha_inicio", "id_historico_precio"], ["precio", "costo"])
    listed = products.select("id_producto", "precio_unitario", "costo_unitario")
    return listed.join(latest, "id_producto", "left").select(
        "id_producto",
        F.coalesce(F.col("precio").cast("double"), "precio_unitario").alias("precio"),
        F.coalesce(F.col("costo").cast("double"), "costo_unitario").alias("costo"),
        "fecha_inicio",
        "id_historico_precio",
    )


def price_validity(history: DataFrame) -> DataFrame:
    """End of each price = start of the next one; null while it is in force."""
    return next_start(history, "id_producto", "fecha_inicio", "id_historico_precio", "fecha_fin")


def product_versions(
    products: DataFrame, history: DataFrame, strict: bool = False, first_day: date = FIRST_DAY
) -> DataFrame:
    """Versions of the product dimension ``products`` from its price change log, not numbered yet.

    One pass over the log: the changes of a product and month are one array, which knows the
    start of the change after it, so that the end, the current row and the list-price fallback
    come from the same rows.  Products meet those arrays, not single changes.  An end that the
    log itself states (``fecha_fin``) counts unless ``strict``.
    """
    given = not strict and "fecha_fin" in history.columns
    log = history.select("id_producto", "fecha_inicio", "id_historico_precio", "precio", "costo", *(["fecha_fin"] if given else []))
    arrays = change_arrays(log, "id_producto", "fecha_inicio", "id_historico_precio")
    if given:
        last = F.max(F.element_at(ROWS, -1)["fecha_inicio"]).over(W.partitionBy("id_producto"))
        arrays = arrays.withColumn("_inicio_ultimo", last)
    named = products.select(
        "id_producto", "nombre_producto", "id_categoria", "nombre_categoria", "id_proveedor", "nombre_proveedor",
        "precio_unitario", "costo_unitario", "activo",
    )
    joined = named.join(arrays, "id_producto", "left").select("*", F.explode_outer(ROWS).alias("_c"))
    rows_ = joined.select(
        *named.columns,
        F.col("_c.id_historico_precio").alias("_id"),
        F.col("_c.precio").cast("double").alias("_precio"),
        F.col("_c.costo").cast("double").alias("_costo"),
        F.to_date("_c.fecha_inicio").alias("_inicio"),
        (F.to_date(F.coalesce("_c.fecha_fin", "_inicio_ultimo")) if given else F.to_date(f"_c.{NEXT}")).alias("_fin"),
        F.col(f"_c.{NEXT}").isNull().alias("_es_ultimo"),
    )
    is_now = F.col("_es_ultimo")
    since = F.coalesce("_inicio", F.lit(first_day))
    price, cost = F.coalesce("_precio", "precio_unitario"), F.coalesce("_costo", "costo_unitario")
    return rows_.select(
        F.col("id_producto").alias("id_producto_nk"),
        "nombre_producto",
        "id_categoria",
        "nombre_categoria",
        "id_proveedor",
        "nombre_proveedor",
        price.alias("precio_unitario"),
        cost.alias("costo_unitario"),
        guarded_margin_pct(price, cost).alias("margen_pct"),
        "activo",
        (since if strict else F.when(is_now, F.lit(first_day)).otherwise(since)).alias("fecha_inicio"),
        F.when(is_now, F.lit(OPEN_END)).otherwise(F.col("_fin")).alias("fecha_fin"),
        is_now.cast("int").alias("es_actual"),
        F.coalesce("_id", F.lit(0)).alias("_orden"),
    )


def scd2_product(
    products: DataFrame, history: DataFrame, strict: bool = False, first_day: date = FIRST_DAY
) -> DataFrame:
    """``product_versions`` with a surrogate key."""
    order = [F.col("es_actual").desc(), "id_producto_nk", "fecha_inicio", "_orden"]
    return dense_keys(product_versions(products, history, strict, first_day), order, "id_producto_sk").drop("_orden")


def segment_history(
    customers: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    cutoffs: Sequence[date] | Column,
    rule: SegmentRule = SNAPSHOT_RULE,
    strict: bool = False,
) -> DataFrame:
    """Snapshots at which the segment of a customer changed, with version and validity."""
    key = W.partitionBy("id_cliente").orderBy("corte")
    snapshots = rfm_as_of(customers, orders, lines, cutoffs).withColumn(
        "segmento_rfm", rfm_segment("recency", "frecuencia", "monto", rule)
    )
    previous = F.lag("segmento_rfm").over(key)
    changed = snapshots.withColumn("_antes", previous).where(
        F.col("_antes").isNull() | (F.col("_antes") != F.col("segmento_rfm"))
    )
    following = F.lead("corte").over(key)
    return (
        changed.withColumn("version", F.row_number().over(key))
        .withColumn("_fin", following)
        .withColumn("es_actual", F.col("_fin").isNull().cast("int"))
        .withColumn("fecha_fin", F.coalesce("_fin", F.lit(OPEN_END)) if strict else F.lit(OPEN_END))
        .drop("_antes", "_fin")
    )


def customer_versions(
    customers: DataFrame,
    cities: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    cutoffs: Sequence[date] | Column,
    rule: SegmentRule = SNAPSHOT_RULE,
    strict: bool = False,
) -> DataFrame:
    """Versions of the customer dimension, one per change of segment, not numbered yet."""
    place = cities.select("id_ciudad", F.col("nombre").alias("nombre_ciudad"), "region", "zona")
    located = customers.join(place, "id_ciudad")
    history = segment_history(located, orders, lines, cutoffs, rule, strict)
    return located.join(history, "id_cliente").select(
        F.col("id_cliente").alias("id_cliente_nk"),
        F.col("nombre").alias("nombre_cliente"),
        "email",
        "nombre_ciudad",
        "region",
        "zona",
        "edad",
        "genero",
        "fecha_registro",
        "segmento_rfm",
        F.col("recency").alias("recency_dias"),
        F.col("frecuencia").alias("frecuencia_compras"),
        F.col("monto").cast("long").alias("monto_total"),
        F.col("corte").alias("fecha_inicio"),
        "fecha_fin",
        "es_actual",
        "version",
    )


def scd2_customer(
    customers: DataFrame,
    cities: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    cutoffs: Sequence[date] | Column,
    rule: SegmentRule = SNAPSHOT_RULE,
    strict: bool = False,
) -> DataFrame:
    """``customer_versions`` with a surrogate key."""
    versions = customer_versions(customers, cities, orders, lines, cutoffs, rule, strict)
    return dense_keys(versions, ["id_cliente_nk", "version"], "id_cliente_sk")


def versions_per_key(dimension: DataFrame, key: str) -> DataFrame:
    return dimension.groupBy(key).agg(rows().alias("versiones"), F.sum("es_actual").alias("actuales"))


def scd_audit(dimension: DataFrame, key: str, label: str) -> DataFrame:
    """One row: natural keys, versions, current and past versions, keys with a change."""
    return versions_per_key(dimension, key).agg(
        F.lit(label).alias("dimension"),
        rows().alias("claves"),
        F.coalesce(F.sum("versiones"), F.lit(0)).alias("versiones"),
        F.coalesce(F.sum("actuales"), F.lit(0)).alias("actuales"),
        F.coalesce(F.sum(F.col("versiones") - F.col("actuales")), F.lit(0)).alias("historicas"),
        F.count(F.when(F.col("versiones") > 1, 1)).alias("claves_con_cambios"),
    )


def first_changed_key(dimension: DataFrame, key: str) -> DataFrame:
    """Every version of the smallest key that has more than one version."""
    changed = versions_per_key(dimension, key).where(F.col("versiones") > 1)
    return dimension.where(F.col(key) == changed.agg(F.min(key)).scalar())
