"""Sales fact and its denormalised star."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns of the order header and of the fact table.
HEADER = ["id_cliente", "id_empleado", "id_tienda", "id_metodo_pago", "fecha_orden", "estado"]

FACT = [
    "id_detalle", "id_orden", "id_producto", "id_cliente", "id_empleado", "id_tienda", "id_metodo_pago",
    "id_tiempo", "cantidad", "precio_unitario", "descuento", "subtotal", "fecha_orden", "estado",
]


def order_detail(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their order header: one shuffle of both sides on the order key."""
    header = [c for c in HEADER if c in orders.columns and c not in lines.columns]
    return lines.join(orders.select("id_orden", *header), "id_orden")


CALENDAR = ["anio", "mes", "nombre_mes", "trimestre"]


def unchanged(lines: DataFrame) -> DataFrame:
    return lines


def sales_fact(
    lines: DataFrame,
    orders: DataFrame,
    calendar: DataFrame,
    attributes: Sequence[str] = (),
    amounts: Callable[[DataFrame], DataFrame] = unchanged,
) -> DataFrame:
    """Detail rows with the surrogate date key; rows without a calendar day drop out.

    ``attributes`` of the calendar can be taken along from the same lookup.  ``amounts`` computes
    the amounts of joined lines, so that the join moves only what they are computed from.
    """
    # The calendar has one row per day at most, which bounds the broadcast.
    days = F.broadcast(calendar.select("id_tiempo", "fecha_date", *attributes))
    return (
        amounts(order_detail(lines, orders))
        .withColumn("fecha_date", F.to_date("fecha_orden"))
        .join(days, "fecha_date")
        .na.drop(subset=["id_tiempo"])
        .drop("fecha_date")
        .select(*FACT, *attributes)
    )


def star(
    fact: DataFrame,
    calendar: DataFrame | None = None,
    products: DataFrame | None = None,
    customers: DataFrame | None = None,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Fact joined with the dimensions a query needs.

    City attributes occur on customers and on stores, so they are exposed as
    ``ciudad_cliente`` / ``ciudad_tienda`` and likewise for region and zone.
    """
    out = fact
    if calendar is not None:
        out = out.join(F.broadcast(calendar.select("id_tiempo", *CALENDAR)), "id_tiempo")
    if products is not None:
        out = out.join(products.select("id_producto", "nombre_producto", "nombre_categoria", "margen_pct"), "id_producto")
    if customers is not None:
        out = out.join(
            customers.select(
                "id_cliente",
                "nombre_cliente",
                "segmento_rfm",
                F.col("nombre_ciudad").alias("ciudad_cliente"),
                F.col("region").alias("region_cliente"),
                F.col("zona").alias("zona_cliente"),
            ),
            "id_cliente",
        )
    if stores is not None:
        out = out.join(
            stores.select(
                "id_tienda",
                "nombre_tienda",
                F.col("tipo").alias("tipo_tienda"),
                F.col("nombre_ciudad").alias("ciudad_tienda"),
                F.col("region").alias("region_tienda"),
                F.col("zona").alias("zona_tienda"),
            ),
            "id_tienda",
        )
    return out
