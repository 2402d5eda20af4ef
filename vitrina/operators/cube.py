"""Sales cube with five levels of detail.

Levels 2 to 4 come from one state: the lines added up per category and month, with the number of
orders.  Orders are counted by marks on their first line, found in one sort of the lines by
order, so that no line is repeated or added up per order, and the state is a few rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import exact_sum, mean, rows, total
from vitrina.operators.facts import order_detail, unchanged

# Keys and measures of the levels are the columns of the cube tables.
PRODUCT = ["id_producto", "id_categoria", "categoria"]
CATEGORY = ["id_categoria", "categoria"]

LEVELS: dict[int, list[str]] = {
    1: [*PRODUCT, "fecha_date", "anio", "mes", "trimestre"],
    2: [*CATEGORY, "anio", "mes", "trimestre"],
    3: [*CATEGORY, "anio", "trimestre"],
    4: ["anio"],
}

# The keys of level 1 in the order of its sort: product and day tell its groups apart.
DAILY = ["id_producto", "fecha_date", *(c for c in LEVELS[1] if c not in ("id_producto", "fecha_date"))]

DETAIL = [
    "id_detalle", "id_orden", "id_producto", "id_cliente", "id_empleado", "id_tienda", "id_metodo_pago",
    "id_categoria", "fecha_date", "anio", "mes", "trimestre", "cantidad", "precio_unitario", "descuento",
    "subtotal", "estado",
]


# What the levels above the detail read.
READ = [*LEVELS[1], "id_orden", "cantidad", "subtotal", "descuento", "precio_unitario"]


def cube_base(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    amounts: Callable[[DataFrame], DataFrame] = unchanged,
    first: str = "orders",
) -> DataFrame:
    """Detail rows with calendar fields and category; lines of unknown products stay.

    The lines meet their ``first`` side before the other one, whose key the result is then hashed on: a
    detail moves least with ``products`` first, and level 1 groups where the products met with ``orders`` first.
    ``amounts`` computes the amounts of joined lines, so that the joins move only what they are computed from.
    """
    category = products.select("id_producto", "id_categoria").join(
        categories.select("id_categoria", F.col("nombre").alias("categoria")), "id_categoria"
    )
    if first == "products":
        joined = order_detail(lines.join(category, "id_producto", "left"), orders)
    else:
        joined = order_detail(lines, orders).join(category, "id_producto", "left")
    return amounts(joined).withColumns(
        {
            "anio": F.year("fecha_orden"),
            "mes": F.month("fecha_orden"),
            "trimestre": F.quarter("fecha_orden"),
            "fecha_date": F.to_date("fecha_orden"),
        }
    )


STATE = [*CATEGORY, "anio", "mes", "trimestre"]


def _marked(base: DataFrame) -> DataFrame:
    """Lines with a mark on the first one of an order in a group of the state, and in a year.

    The first line of a year has a known category if any line of the order has one, so the marks also
    count the orders of the known categories.
    """
    unknown = F.col("id_categoria").isNull() | F.col("categoria").isNull()
    group = F.struct(*CATEGORY, "mes", "trimestre")
    seen = W.partitionBy("id_orden", "anio").orderBy(unknown, *CATEGORY, "mes", "trimestre")
    keyed = F.col("id_orden").isNotNull()
    previous = base.withColumns({"_fila": F.row_number().over(seen), "_grupo": F.lag(group).over(seen)})
    return previous.withColumns(
        {
            "_orden": (keyed & ~F.col("_grupo").eqNullSafe(group)).cast("long"),
            "_orden_anio": (keyed & (F.col("_fila") == 1)).cast("long"),
        }
    )


def cube_state(base: DataFrame) -> DataFrame:
    """Lines added up per category and month with their orders, the source of levels 2 to 4.

    ``_ordenes_anio`` counts an order in the first group it has in a year, so its sums over a year are
    distinct orders.  Unknown categories are a group of their own.
    """
    return _marked(base).groupBy(*STATE).agg(
        F.sum("cantidad").alias("_cantidad"),
        exact_sum("subtotal").alias("_ventas"),
        exact_sum("descuento").alias("_descuento"),
        F.count("subtotal").alias("_lineas"),
        F.sum("_orden").alias("_ordenes"),
        F.sum("_orden_anio").alias("_ordenes_anio"),
    )


def level_of_state(state: DataFrame, level: int) -> DataFrame:
    """Common measures of level 2, 3 or 4; groups with an unknown key are left out."""
    keys = LEVELS[level]
    sales = exact_sum("_ventas").cast("double")
    # Categories are few, which bounds the set of a year.
    own = [F.size(F.collect_set("id_categoria")).cast("long").alias("categorias_activas")] if level == 4 else []
    return state.na.drop(subset=keys).groupBy(*keys).agg(
        F.sum("_cantidad").alias("cantidad_vendida"),
        F.coalesce(sales, F.lit(0.0)).alias("ventas_totales"),
        total("_descuento").alias("descuento_total"),
        F.sum("_ordenes_anio" if level == 4 else "_ordenes").alias("transacciones"),
        F.try_divide(sales, F.sum("_lineas")).alias("ticket_promedio"),
        *own,
    )


def _level_1(base: DataFrame) -> DataFrame:
    """Measures per product and day of lines whose keys are known.

    ``descuento_total`` adds rates and ``ticket_promedio`` is the mean line, as in the existing cube.
    Orders are counted by a mark on their first line in the sorted group, which takes one sort that
    can spill where distinct counts keep two tables of groups and two of groups and orders.
    """
    keys = DAILY
    order = F.col("id_orden")
    previous = F.lag(order).over(W.partitionBy(*keys).orderBy(order))
    marked = base.na.drop(subset=keys).withColumn("_orden", (order.isNotNull() & ~previous.eqNullSafe(order)).cast("long"))
    level = marked.groupBy(*keys).agg(
        F.sum("cantidad").alias("cantidad_vendida"),
        total("subtotal").alias("ventas_totales"),
        total("descuento").alias("descuento_total"),
        F.sum("_orden").alias("transacciones"),
        mean("subtotal").alias("ticket_promedio"),
        F.avg("precio_unitario").alias("precio_promedio"),
    )
    return level.select(*LEVELS[1], *level.columns[len(keys) :])


def _products(base: DataFrame) -> DataFrame:
    """Distinct products of the groups of level 2, from distinct pairs."""
    keys = LEVELS[2]
    pairs = base.select(*keys, "id_producto").na.drop(subset=keys).distinct()
    return pairs.groupBy(*keys).agg(F.count("id_producto").alias("productos_distintos"))


def cube_level(base: DataFrame, level: int, state: DataFrame | None = None) -> DataFrame:
    """Level 0 is the detail; rows with an unknown group key belong to no group.

    ``state`` is the stored state of ``base``, where several levels are wanted.
    """
    if level == 0:
        return base.select(*DETAIL, F.lit(0).alias("cubo_nivel"))
    if level > 1:
        out = level_of_state(cube_state(base) if state is None else state, level)
        if level == 2:
            out = out.join(_products(base), LEVELS[2])
        if level == 4:
            out = out.withColumn("categoria", F.lit("Todas"))
        return out.withColumn("cubo_nivel", F.lit(level))
    return _level_1(base).withColumn("cubo_nivel", F.lit(level))


def cube_grouping_sets(base: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Levels 1 to 4 with their common measures, of the lines whose product is known.

    No row is repeated per level: level 1 counts each line once, the others merge one state.
    """
    state = cube_state(base) if state is None else state
    state = state.na.drop(subset=CATEGORY)
    out = _level_1(base).drop("precio_promedio").withColumn("cubo_nivel", F.lit(1))
    for level in (2, 3, 4):
        part = level_of_state(state, level).drop("categorias_activas").withColumn("cubo_nivel", F.lit(level))
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def cube_reconcile(base: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Rows and total sales per level; the totals must agree."""
    state = cube_state(base) if state is None else state
    parts = []
    for number in (0, *LEVELS):
        # The base has the rows of the detail; the distinct products of level 2 add none.
        out = base if number == 0 else _level_1(base) if number == 1 else level_of_state(state, number)
        amount = "subtotal" if number == 0 else "ventas_totales"
        parts.append(out.agg(F.lit(number).alias("nivel"), rows().alias("filas"), total(amount).alias("ventas_totales")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
