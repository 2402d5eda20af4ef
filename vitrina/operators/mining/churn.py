"""Churn: label, features, split, tree models and their quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import ratio, rows
from vitrina.functions.rules import CHURN_DAYS, NO_ORDER_RECENCY, churned, stable_hash
from vitrina.operators.mining.cluster import feature_vectors
from vitrina.operators.rfm import customer_activity
from vitrina.session import scratch_path, stored

FEATURES = ["recency", "frecuencia", "monto_total", "tasa_devolucion", "dias_desde_registro"]
LEAKY = ["recency"]  # the label is a threshold on it
BUCKET_BITS = 10


def churn_label(customers: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    return customers.withColumn("churn", churned("recency", days))


def churn_rate(labelled: DataFrame, label: str = "churn") -> DataFrame:
    return labelled.agg(
        rows().alias("clientes"),
        F.sum(label).alias("positivos"),
        F.sum(1 - F.col(label)).alias("negativos"),
        F.avg(label).alias("tasa"),
    )


def churn_features(customers: DataFrame, orders: DataFrame, lines: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """RFM plus share of returned lines and days since the first order, for every customer."""
    activity = customers.select("id_cliente").join(customer_activity(orders, lines), "id_cliente", "left")
    return activity.select(
        "id_cliente",
        F.coalesce("recency", F.lit(NO_ORDER_RECENCY)).alias("recency"),
        F.coalesce("frecuencia", F.lit(0)).alias("frecuencia"),
        F.coalesce(F.col("monto_total").cast("long"), F.lit(0)).alias("monto_total"),
        F.coalesce(ratio("devueltas", "lineas"), F.lit(0.0)).alias("tasa_devolucion"),
        F.coalesce("antiguedad", F.lit(0)).alias("dias_desde_registro"),
    ).transform(lambda df: churn_label(df, days))


def with_split(df: DataFrame, key: str, train_pct: int = 70, seed: int = 42) -> DataFrame:
    """Adds ``es_entrenamiento``; the side of a row depends on its key and the seed only."""
    return df.withColumn("es_entrenamiento", stable_hash(key, seed) % 100 < train_pct)


def with_fold(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold``: the rows of a class, in hashed order, are dealt to the folds in turn.

    Rows are numbered inside buckets of the hash, so a class is no single task.
    """
    hashed = df.withColumn("_hash", stable_hash(key, seed)).withColumn("_bucket", F.shiftright("_hash", 32 - BUCKET_BITS))
    sizes = hashed.groupBy(label, "_bucket").agg(rows().alias("_n"))
    # At most 2 ** BUCKET_BITS rows per class reach this window and the broadcast.
    earlier = W.partitionBy(label).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(label, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(label, "_bucket").orderBy("_hash", key))
    numbered = hashed.withColumn("_row", inside).join(F.broadcast(offsets), [label, "_bucket"])
    fold = (F.col("_before") + F.col("_row") - 1) % folds
    return numbered.withColumn("fold", fold.cast("int")).drop("_hash", "_bucket", "_row", "_before")


def with_balanced_weight(df: DataFrame, label: str) -> DataFrame:
    """Adds ``peso`` = rows / (classes * rows of the class)."""
    sizes = df.groupBy(label).agg(rows().alias("_n"))
    weights = sizes.withColumn(
        "peso", ratio(sizes.agg(F.sum("_n")).scalar(), F.col("_n") * sizes.agg(rows()).scalar())
    )
    # One row per class.
    return df.join(F.broadcast(weights.drop("_n")), label)


def forest(label: str = "churn", seed: int = 42, trees: int = 100, depth: int = 6) -> RandomForestClassifier:
    """Balanced forest; five rows per leaf stands in for ten rows per split."""
    return RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol="peso", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=5, seed=seed,
    )


def tree(label: str = "churn", seed: int = 42, depth: int = 4) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=depth, seed=seed)


def feature_list(exclude_leaky: bool = False) -> list[str]:
    return [f for f in FEATURES if not (exclude_leaky and f in LEAKY)]


def training_frame(features: DataFrame, exclude_leaky: bool = False, seed: int = 42) -> DataFrame:
    """Split and assembled features, computed once for all passes of a model."""
    return feature_vectors(with_split(stored(features), "id_cliente", seed=seed), feature_list(exclude_leaky))


def fit(estimator: RandomForestClassifier | DecisionTreeClassifier, train: DataFrame, label: str = "churn") -> Model:
    """Fit on ``train``, balanced over its own classes; the model carries no training summary."""
    train = with_balanced_weight(train, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return without_summary(estimator.fit(train), train.sparkSession)
    finally:
        train.unpersist()


def without_summary(model: Model, spark: SparkSession) -> Model:
    """The model as stored and read back.

    The training summary of a forest holds its session, and predictions carry the whole model to the
    tasks.  A session that has observed a metric cannot be carried there; a model that was read has no summary.
    """
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(spark, "modelo")
    model.save(path)
    return type(model).load(path)


def fit_on_train(estimator: RandomForestClassifier | DecisionTreeClassifier, frame: DataFrame) -> Model:
    return fit(estimator, frame.where("es_entrenamiento"))


def test_predictions(model: Model, frame: DataFrame) -> DataFrame:
    scored = model.transform(frame.where(~F.col("es_entrenamiento")))
    return scored.select(
        "id_cliente",
        "churn",
        F.col("prediction").cast("int").alias("prediccion"),
        vector_to_array("probability")[1].alias("probabilidad"),
    )


def importance(model: Model, features: Sequence[str], frame: DataFrame) -> DataFrame:
    """Feature importance, largest first."""
    values = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]
    table = frame.sparkSession.createDataFrame(values, "feature STRING, importancia DOUBLE")
    return table.orderBy(F.desc("importancia"), "feature")


def tree_rules(model: Model, features: Sequence[str], frame: DataFrame) -> DataFrame:
    """The printed splits of a tree, one line per row, with feature names."""
    lines = model.toDebugString.splitlines()[1:]
    named = []
    for number, text in enumerate(lines, 1):
        for i, feature in enumerate(features):
            text = text.replace(f"(feature {i} ", f"({feature} ")
        named.append((number, text.rstrip()))
    return frame.sparkSession.createDataFrame(named, "linea INT, regla STRING")


def cross_validate(
    estimator: RandomForestClassifier | DecisionTreeClassifier,
    frame: DataFrame,
    label: str,
    key: str,
    folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Mean accuracy over stratified folds; each fit weighs the classes of its own rows."""
    folded = with_fold(frame, key, label, folds, seed).persist(StorageLevel.MEMORY_AND_DISK)
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    try:
        found = [
            evaluator.evaluate(fit(estimator, folded.where(F.col("fold") != left_out), label).transform(held_out))
            for left_out in range(folds)
            if not (held_out := folded.where(F.col("fold") == left_out)).isEmpty()
        ]
    finally:
        folded.unpersist()
    accuracy = sum(found) / len(found) if found else None
    return frame.sparkSession.createDataFrame([(folds, accuracy)], "folds INT, exactitud_media DOUBLE")
