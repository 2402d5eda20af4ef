"""Decision trees as tables: evaluation, node counts and importance as plans.

A tree is a table with one row per node: ``nodo``, ``padre`` and ``lado`` (null at the root),
``feature`` and ``limite`` (null at a leaf), ``prediccion``.  A row goes to the side ``<=`` if its
value is at most the limit and to ``>`` otherwise.  Tables of fitted models have the same form, so a
fitted tree and a tree written by hand are evaluated, counted and weighed by the same plans.

A tree of depth d has fewer than 2 ** (d + 1) nodes; the depth is a parameter of every model
here, which bounds the broadcasts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.measures import ratio

NODES = "nodo INT, padre INT, lado STRING, feature STRING, limite DOUBLE, prediccion INT"
LEFT, RIGHT = "<=", ">"


def tree_table(spark: SparkSession, nodes: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(nodes), NODES)


def _links(nodes: DataFrame) -> DataFrame:
    """Nodes with both children; a leaf has none."""
    children = nodes.where(F.col("padre").isNotNull()).groupBy(F.col("padre").alias("nodo")).agg(
        F.max(F.when(F.col("lado") == LEFT, F.col("nodo"))).alias("_izquierda"),
        F.max(F.when(F.col("lado") == RIGHT, F.col("nodo"))).alias("_derecha"),
    )
    return nodes.select("nodo", "feature", "limite", "prediccion").join(children, "nodo", "left")


def paths(rows: DataFrame, nodes: DataFrame, features: Sequence[str], depth: int) -> DataFrame:
    """``rows`` with ``camino``, the nodes each passes from the root to its leaf, and the leaf's ``prediccion``.

    One broadcast lookup per level; rows of shallower leaves stay where they are.  A null value
    goes to the right, as it is at most no limit.
    """
    links = _links(nodes)
    root = nodes.where(F.col("padre").isNull()).agg(F.min("nodo")).scalar()
    values = F.map_from_arrays(F.array(*map(F.lit, features)), F.array(*[F.col(c).cast("double") for c in features]))
    out = rows.withColumn("_valores", values).withColumn("_nodo", root).withColumn("camino", F.array("_nodo"))
    for _ in range(depth):
        here = links.select(F.col("nodo").alias("_nodo"), "feature", "limite", "_izquierda", "_derecha")
        out = out.join(F.broadcast(here), "_nodo", "left")
        low = F.coalesce(F.element_at("_valores", F.col("feature")) <= F.col("limite"), F.lit(False))
        following = F.when(F.col("feature").isNotNull(), F.when(low, F.col("_izquierda")).otherwise(F.col("_derecha")))
        out = out.withColumn("_siguiente", following).drop("feature", "limite", "_izquierda", "_derecha")
        grown = F.when(F.col("_siguiente").isNotNull(), F.array_append("camino", F.col("_siguiente"))).otherwise(F.col("camino"))
        out = out.withColumn("camino", grown).withColumn("_nodo", F.coalesce("_siguiente", "_nodo")).drop("_siguiente")
    leaf = links.select(F.col("nodo").alias("_nodo"), "prediccion")
    return out.join(F.broadcast(leaf), "_nodo", "left").drop("_nodo", "_valores")


def node_counts(walked: DataFrame, nodes: DataFrame, label: str, weight: Column | None = None) -> DataFrame:
    """Rows, positive rows and Gini impurity per node; nodes that no row passes count zero."""
    weight = F.lit(1.0) if weight is None else weight
    passed = walked.select(F.explode("camino").alias("nodo"), F.col(label).cast("double").alias("_y"), weight.cast("double").alias("_w"))
    sums = passed.groupBy("nodo").agg(F.count(F.lit(1)).alias("filas"), F.sum("_w").alias("_peso"), F.sum(F.col("_w") * F.col("_y")).alias("_si"))
    p = ratio("peso_positivo", "peso")
    return (
        nodes.join(sums, "nodo", "left")
        .select(
            *nodes.columns,
            F.coalesce("filas", F.lit(0)).alias("filas"),
            F.coalesce("_peso", F.lit(0.0)).alias("peso"),
            F.coalesce("_si", F.lit(0.0)).alias("peso_positivo"),
        )
        .withColumn("gini", F.coalesce(2 * p * (1 - p), F.lit(0.0)))
    )


def importance(counts: DataFrame, features: Sequence[str]) -> DataFrame:
    """Share of each feature in the impurity that the splits remove, of all features, from ``node_counts``."""
    children = counts.where(F.col("padre").isNotNull()).groupBy(F.col("padre").alias("nodo"))
    children = children.agg(F.sum(F.col("peso") * F.col("gini")).alias("_quedan"))
    gains = counts.where(F.col("feature").isNotNull()).join(children, "nodo")
    gains = gains.groupBy("feature").agg(F.sum(F.col("peso") * F.col("gini") - F.col("_quedan")).alias("_ganancia"))
    all_gains = gains.agg(F.sum("_ganancia")).scalar()
    named = counts.sparkSession.createDataFrame([(f,) for f in features], "feature STRING")
    share = F.coalesce(ratio("_ganancia", all_gains), F.lit(0.0)).alias("importancia")
    return named.join(F.broadcast(gains), "feature", "left").select("feature", share)


def _walk(node, parent: int | None, side: str | None, features: Sequence[str], out: list[tuple]) -> None:
    number = len(out)
    leaf = node.subtreeDepth() == 0
    feature = None if leaf else features[node.split().featureIndex()]
    limit = None if leaf else float(node.split().threshold())
    out.append((number, parent, side, feature, limit, int(node.prediction())))
    if not leaf:
        _walk(node.leftChild(), number, LEFT, features, out)
        _walk(node.rightChild(), number, RIGHT, features, out)


def exported(model: Model, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """The nodes of a fitted tree on continuous features, in the form of ``tree_table``."""
    found: list[tuple] = []
    _walk(model._call_java("rootNode"), None, None, features, found)
    return tree_table(spark, found)
