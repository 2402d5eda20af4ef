"""K-Means segmentation of customers on scaled RFM values."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import rows
from vitrina.session import stored

RFM = ("recency", "frecuencia", "monto_total")
# Starts and iterations of the existing segmentation.
STARTS, ITERATIONS = 10, 300
ELBOW = "k INT, inercia DOUBLE, silueta DOUBLE, metrica STRING"


def standardize(df: DataFrame, columns: Sequence[str] = RFM, suffix: str = "_z") -> DataFrame:
    """(x - mean) / population deviation; 0 for a constant column.

    The moments come from one aggregate and are read back as scalars of the plan.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns]
        ).alias("m")
    ).scalar()
    scaled = df.withColumn("_m", moments)
    return scaled.withColumns(
        {
            f"{c}{suffix}": F.coalesce(
                F.try_divide(F.col(c) - F.col("_m")[f"{c}_m"], F.col("_m")[f"{c}_s"]), F.lit(0.0)
            )
            for c in columns
        }
    ).drop("_m")


def scaled_rfm(customers: DataFrame) -> DataFrame:
    """Standardized RFM; stored first because moments and rows are two passes."""
    return standardize(stored(customers.select("id_cliente", *RFM)))


def feature_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def fit_best(vectors: DataFrame, k: int, seed: int = 42, restarts: int = STARTS, weight: str | None = None) -> KMeansModel:
    """The lowest-cost model of several k-means|| starts; ``weight`` counts how often a vector occurs."""
    given = {"weightCol": weight} if weight else {}
    models = [KMeans(k=k, seed=seed + i, maxIter=ITERATIONS, **given).fit(vectors) for i in range(restarts)]
    return min(models, key=lambda m: m.summary.trainingCost)


def scaled_vectors(customers: DataFrame) -> DataFrame:
    """Scaled features, computed once for all passes of the clustering."""
    return feature_vectors(stored(scaled_rfm(customers)), [f"{c}_z" for c in RFM])


WEIGHT = "peso"


def weighted_vectors(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each distinct point once, with its number of rows: all that the cost of a clustering depends on."""
    counted = points.groupBy(*columns).agg(rows().cast("double").alias(WEIGHT))
    return feature_vectors(counted, columns).select("features", WEIGHT)


def assigned_moments(points: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Per cluster: size, sum of every column and sum of the squared norms, all a distance needs."""
    norm = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    return points.groupBy(cluster).agg(
        rows().cast("double").alias("n"), F.array(*[F.sum(c) for c in columns]).alias("suma"), F.sum(norm).alias("norma")
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def inertia(points: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Per cluster of any assignment: size and squared distances to its centre."""
    moments = assigned_moments(points, cluster, columns)
    spread = _spread(F.struct("n", "suma", "norma"))
    return moments.select(cluster, F.col("n").cast("long").alias("clientes"), spread.alias("inercia"))


def _spread(m: Column) -> Column:
    """Squared distances of a cluster's points to their centre."""
    return F.greatest(m["norma"] - _dot(m["suma"], m["suma"]) / m["n"], F.lit(0.0))


def silhouette(points: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """``points`` with the squared-Euclidean silhouette of each, for any assignment."""
    return _measured(points, cluster, columns).drop("_m")


def _measured(points: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """``points`` with their silhouette and the moments of all clusters.

    The mean squared distance of x to a cluster is |x|^2 + (sum |y|^2 - 2 x . sum y) / n, so one
    row of moments per cluster is enough and the cost is rows times clusters.  A cluster of one
    has silhouette 0, as has an assignment with one cluster.
    """
    moments = assigned_moments(points, cluster, columns).where(F.col(cluster).isNotNull())
    # One row: an entry per cluster, which bounds it as the number of clusters is a parameter.
    table = moments.agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "n", "suma", "norma"))).scalar()
    x = F.array(*[F.col(c).cast("double") for c in columns])
    norm = _dot(F.col("_x"), F.col("_x"))

    def apart(m: Column) -> Column:
        return F.greatest(norm + (m["norma"] - 2 * _dot(F.col("_x"), m["suma"])) / m["n"], F.lit(0.0))

    own = F.get(F.filter("_m", lambda m: m["c"] == F.col(cluster)), 0)
    inside = F.try_divide(apart(own) * own["n"], own["n"] - 1)
    others = F.array_min(F.transform(F.filter("_m", lambda m: m["c"] != F.col(cluster)), apart))
    value = F.when((own["n"] > 1) & others.isNotNull(), F.coalesce(F.try_divide(others - inside, F.greatest(inside, others)), F.lit(0.0)))
    measured = points.withColumn("_x", x).withColumn("_m", table)
    return measured.withColumn("silueta", value.otherwise(F.lit(0.0))).drop("_x")


def quality(points: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """One row: clusters, inertia and mean silhouette of an assignment; ``points`` is read twice."""
    found = _measured(points, cluster, columns).agg(F.avg("silueta").alias("silueta"), F.first("_m").alias("_m"))
    spread = F.aggregate("_m", F.lit(0.0), lambda total, m: total + _spread(m))
    return found.select(F.size("_m").alias("k"), spread.alias("inercia"), "silueta")


def amount_bands(points: DataFrame, column: str, k: int) -> DataFrame:
    """An assignment that needs no model: ``k`` bands of equal width between least and greatest value."""
    edges = points.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo")) / k
    band = F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("_e.lo"), width)), F.lit(0))
    return points.withColumn("_e", edges).withColumn("cluster", F.least(band, F.lit(k - 1)).cast("int")).drop("_e")


def elbow(
    customers: DataFrame, ks: Sequence[int] = range(2, 11), seed: int = 42, restarts: int = STARTS, parallelism: int = 4
) -> DataFrame:
    """Inertia and silhouette (squared Euclidean, linear cost) per number of clusters.

    Several fits run at a time, since the jobs of one fit wait for each other.  They iterate over the
    distinct points, weighted by their customers; the measures are those of all customers.
    """
    scaled = [f"{c}_z" for c in RFM]
    vectors = scaled_vectors(customers).select("features", *scaled).persist(StorageLevel.MEMORY_AND_DISK)
    points = stored(weighted_vectors(vectors, scaled), "puntos")

    def measure(k: int) -> tuple[int, float, float, str]:
        model = fit_best(points, k, seed, restarts, WEIGHT)
        found = quality(model.transform(vectors), "prediction", scaled).first()
        return k, found.inercia, found.silueta, "squaredEuclidean"

    try:
        with ThreadPool(parallelism) as pool:
            result = pool.map(measure, ks)
    finally:
        vectors.unpersist()
    return customers.sparkSession.createDataFrame(result, ELBOW)


def best_k(elbow_table: DataFrame) -> DataFrame:
    """The number of clusters with the highest silhouette."""
    # Equal silhouettes go to the smaller number.
    best = F.max(F.struct("silueta", (-F.col("k")).alias("_menos"))).alias("_m")
    return elbow_table.agg(best).select((-F.col("_m._menos")).alias("k"), F.col("_m.silueta").alias("silueta"))


def segments(customers: DataFrame, k: int = 4, seed: int = 42, restarts: int = STARTS) -> DataFrame:
    """Customer with its cluster; clusters are numbered from 0 by descending mean amount."""
    vectors = scaled_vectors(customers).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        points = stored(weighted_vectors(vectors, [f"{c}_z" for c in RFM]), "puntos")
        model = fit_best(points, k, seed, restarts, WEIGHT)
    finally:
        vectors.unpersist()
    assigned = model.transform(vectors).select("id_cliente", *RFM, F.col("prediction").alias("_p"))
    # One row per cluster reaches this window.
    order = W.orderBy(F.desc("_media"), "_p")
    names = (
        assigned.groupBy("_p")
        .agg(F.avg("monto_total").alias("_media"))
        .select("_p", (F.row_number().over(order) - 1).alias("cluster"))
    )
    return assigned.join(F.broadcast(names), "_p").drop("_p")


def profile(assigned: DataFrame) -> DataFrame:
    """Size and mean recency, frequency and amount per cluster."""
    return assigned.groupBy("cluster").agg(
        rows().alias("clientes"), *[F.bround(F.avg(c), 1).alias(f"{c}_media") for c in RFM]
    )
