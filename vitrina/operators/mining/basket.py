"""Market baskets: frequent item sets and association rules over all orders."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import rows
from vitrina.session import stored

ITEMSETS = "items ARRAY<STRING>, frecuencia BIGINT, soporte DOUBLE"


def basket_items(lines: DataFrame, order: str = "id_orden", item: str = "id_producto") -> DataFrame:
    """Distinct (order, item) pairs, the long form of the basket matrix."""
    return lines.select(order, item).na.drop().distinct()


def baskets(pairs: DataFrame, order: str = "id_orden", item: str = "id_producto") -> DataFrame:
    """Sorted distinct items per order."""
    return pairs.groupBy(order).agg(F.sort_array(F.collect_set(item)).alias("items"))


def basket_sample(orders: DataFrame, n: int = 500, seed: int = 42, key: str = "id_orden") -> DataFrame:
    """``min(n, rows)`` keys in the order of a seeded hash, the same for every partitioning."""
    return orders.select(key).orderBy(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def _distinct(pairs: DataFrame, order: str, item: str) -> DataFrame:
    """Distinct pairs with a 1 on the first one of each order, from one sort by order."""
    sorted_ = W.partitionBy(order).orderBy(item)
    seen = pairs.withColumns({"_fila": F.row_number().over(sorted_), "_previo": F.lag(item).over(sorted_)})
    first = F.col("_fila") == 1
    kept = seen.where(first | ~F.col("_previo").eqNullSafe(F.col(item)))
    return kept.select(order, item, (first & F.col(order).isNotNull()).cast("int").alias("_primero"))


def frequent_itemsets(
    pairs: DataFrame, min_support: float = 0.03, order: str = "id_orden", item: str = "id_producto"
) -> DataFrame:
    """Item sets that occur in at least ``min_support`` of the orders; ``pairs`` may repeat.

    Items below the threshold can be in no frequent set, so they leave before
    the baskets are built.  What remains is at most (mean basket size /
    min_support) items, which bounds every basket array whatever the order.
    """
    pairs = stored(_distinct(pairs.select(order, F.col(item).cast("string").alias(item)), order, item), "pares")
    # The threshold is a number of orders; the rounding keeps 0.03 * 100 at 3.
    needed = F.ceil(F.round(pairs.agg(F.sum("_primero")).scalar() * min_support, 9))
    frequent = pairs.groupBy(item).agg(rows().alias("_n")).where(F.col("_n") >= F.greatest(needed, F.lit(1)))
    frequent = frequent.select(item, F.lit(True).alias("_frecuente"))
    # Orders without a frequent item stay as empty baskets, so that the weights add up to the orders.
    kept = pairs.join(frequent, item, "left").select(order, F.when(F.col("_frecuente"), F.col(item)).alias("_item"))
    arrays = kept.groupBy(order).agg(F.sort_array(F.collect_set("_item")).alias("items"))
    equal = stored(arrays.groupBy("items").agg(rows().alias("_peso")), "canastas")
    orders = equal.agg(F.sum("_peso")).first()[0]
    if not orders:
        return pairs.sparkSession.createDataFrame([], ITEMSETS)
    found = _mined(equal, max(1, math.ceil(round(min_support * orders, 9))))
    # Kept because the rules join the sets with themselves.
    return stored(found.withColumn("soporte", F.col("frecuencia") / F.lit(orders)), "conjuntos")


def _mined(equal: DataFrame, needed: int) -> DataFrame:
    """Sets in at least ``needed`` baskets, from distinct sorted baskets with their numbers.

    Level by level: each frequent set keeps the items that follow it in its baskets, equal rests
    added up, which is what a frequent-pattern tree shares; a set grows by one item of its rests.
    """
    grown = equal.select(F.array().cast("array<string>").alias("items"), F.col("items").alias("_resto"), "_peso")
    found = []
    while True:
        longer = grown.select("items", "_resto", "_peso", F.posexplode("_resto").alias("_i", "_x")).select(
            F.concat("items", F.array("_x")).alias("items"),
            F.slice("_resto", F.col("_i") + 2, F.size("_resto")).alias("_resto"),
            "_peso",
        )
        longer = stored(longer.groupBy("items", "_resto").agg(F.sum("_peso").alias("_peso")), "prolongados")
        counted = longer.groupBy("items").agg(F.sum("_peso").alias("frecuencia")).where(F.col("frecuencia") >= needed)
        found.append(stored(counted, "frecuentes"))
        open_ = longer.where(F.size("_resto") > 0).join(found[-1].select("items"), "items", "left_semi")
        if open_.isEmpty():
            return functools.reduce(DataFrame.unionByName, found)
        grown = open_


def label(items: Column | str, first: int | None = None) -> Column:
    """Items as text, or only the first few for a chart label."""
    ordered = F.sort_array(items)
    return F.concat_ws(", ", ordered if first is None else F.slice(ordered, 1, first))


def _name(items: Column | str) -> Column:
    return F.array_join(items, "\u0001")


def _grown(splits: DataFrame, supports: DataFrame) -> DataFrame:
    """Consequents with one more item, taken from the antecedent behind the last one; both sides must be known sets."""
    rest = F.filter("antecedente", lambda x: F.col("consecuente").isNull() | (x > F.element_at("consecuente", -1)))
    moved = splits.select("soporte", "antecedente", "consecuente", F.explode(rest).alias("_x")).select(
        "soporte",
        F.filter("antecedente", lambda x: x != F.col("_x")).alias("antecedente"),
        F.concat(F.coalesce("consecuente", F.array().cast("array<string>")), F.array("_x")).alias("consecuente"),
    )
    for side, name in (("antecedente", "soporte_a"), ("consecuente", "soporte_c")):
        known = supports.select(F.col("_k").alias("_s"), F.col("soporte").alias(name))
        moved = moved.withColumn("_s", _name(side)).join(known, "_s").drop("_s")
    return moved


def splits_of(itemsets: DataFrame) -> DataFrame:
    """Every split of a set into two known sets, with the supports of both.

    Level by level: a consequent of n + 1 items comes from one of n, by a join with the sets by
    name, and only up to half of a set, since a split read backwards is one too.  A row gives at
    most as many rows as its set has items, whatever the size of the set.
    """
    supports = itemsets.select(_name("items").alias("_k"), "soporte")
    sets = itemsets.where(F.size("items") > 1)
    largest = sets.agg(F.max(F.size("items"))).first()[0] or 0
    level = sets.select("soporte", F.col("items").alias("antecedente"), F.lit(None).cast("array<string>").alias("consecuente"))
    found = []
    for taken in range(1, largest // 2 + 1):
        open_ = level.where(F.size("antecedente") + taken - 1 >= 2 * taken)
        level = _grown(open_, supports)
        if taken > 1 or largest > 3:
            level = stored(level, "particiones")  # the next level starts from it
        backwards = level.where(F.size("antecedente") > taken).select(
            "soporte",
            F.col("consecuente").alias("antecedente"),
            F.col("antecedente").alias("consecuente"),
            F.col("soporte_c").alias("soporte_a"),
            F.col("soporte_a").alias("soporte_c"),
        )
        found += [level, backwards]
        level = level.drop("soporte_a", "soporte_c")
    if not found:
        return itemsets.limit(0).select("soporte", F.col("items").alias("antecedente"), F.col("items").alias("consecuente"), F.lit(0.0).alias("soporte_a"), F.lit(0.0).alias("soporte_c"))
    return functools.reduce(DataFrame.unionByName, found)


def association_rules(itemsets: DataFrame, min_lift: float = 1.0) -> DataFrame:
    """Every split of a frequent set into antecedent and consequent; items of a set are sorted."""
    joined = splits_of(itemsets)
    confidence = F.col("soporte") / F.col("soporte_a")
    return (
        joined.withColumn("confianza", confidence)
        .withColumn("lift", F.col("confianza") / F.col("soporte_c"))
        .withColumn("leverage", F.col("soporte") - F.col("soporte_a") * F.col("soporte_c"))
        .withColumn(
            "conviccion",
            F.when(F.col("confianza") >= 1, F.lit(float("inf"))).otherwise(
                F.try_divide(1 - F.col("soporte_c"), 1 - F.col("confianza"))
            ),
        )
        .where(F.col("lift") >= min_lift)
        .select(
            "antecedente", "consecuente", "soporte_a", "soporte_c", "soporte", "confianza", "lift", "leverage", "conviccion"
        )
    )


def top_itemsets(itemsets: DataFrame, n: int = 10, first: int | None = None) -> DataFrame:
    """The most frequent sets with their size and text label; ``first`` shortens the label to so many items."""
    shown = itemsets.select(
        label("items", first).alias("etiqueta"), F.size("items").alias("num_items"), "frecuencia", "soporte", label("items").alias("_todos")
    )
    return shown.orderBy(F.desc("frecuencia"), "_todos").limit(n).drop("_todos")


def top_rules(rules: DataFrame, n: int = 5) -> DataFrame:
    """The rules with the highest lift; ties by support and text."""
    shown = rules.select(
        label("antecedente").alias("antecedente"), label("consecuente").alias("consecuente"),
        "soporte", "confianza", "lift",
    )
    rounded = F.round("lift", 9)
    return shown.orderBy(rounded.desc(), F.desc("soporte"), "antecedente", "consecuente").limit(n)
