"""Trees as tables, quality of any assignment, rules by levels, cube levels from one state, measured writes."""

from __future__ import annotations

import itertools
import random
from datetime import date

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from vitrina.operators import audit, cube
from vitrina.operators.mining import basket, churn, cluster, trees
from vitrina.sinks.writers import load_measured, save_all, write_measured

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    draw = random.Random(3)
    rows = [(i, draw.gauss(i % 3 * 4, 1), draw.gauss(i % 2, 1), draw.random() * 5, i % 3, int(draw.random() < 0.2 + 0.3 * (i % 3))) for i in range(600)]
    return spark.createDataFrame(rows, "id INT, a DOUBLE, b DOUBLE, c DOUBLE, g INT, churn INT").cache()


@pytest.mark.parametrize("weighted", [False, True])
def test_exported_tree_weighs_features_as_its_library_does(spark, points, weighted):
    frame = cluster.feature_vectors(points, FEATURES)
    frame = churn.with_balanced_weight(frame, "churn").cache()
    estimator = churn.tree(depth=4).setMinInstancesPerNode(5)
    model = (estimator.setWeightCol("peso") if weighted else estimator).fit(frame)
    nodes = trees.exported(model, FEATURES, spark)
    assert nodes.count() == model.numNodes and nodes.where("padre is null").count() == 1
    walked = trees.paths(frame, nodes, FEATURES, depth=4)
    scored = {r.id: int(r.prediction) for r in model.transform(frame).collect()}
    assert {r.id: r.prediccion for r in walked.collect()} == scored
    counts = trees.node_counts(walked, nodes, "churn", F.col("peso") if weighted else None)
    found = {r.feature: r.importancia for r in trees.importance(counts, FEATURES).collect()}
    for name, expected in zip(FEATURES, model.featureImportances.toArray(), strict=True):
        assert found[name] == pytest.approx(expected, abs=1e-9)


def test_trees_of_one_node_and_null_values(spark):
    leaf = trees.tree_table(spark, [(0, None, None, None, None, 1)])
    rows = spark.createDataFrame([(1, None, 0), (2, 5.0, 1)], "id INT, a DOUBLE, churn INT")
    walked = trees.paths(rows, leaf, ["a"], depth=3)
    assert {(r.id, r.prediccion, tuple(r.camino)) for r in walked.collect()} == {(1, 1, (0,)), (2, 1, (0,))}
    assert [r.importancia for r in trees.importance(trees.node_counts(walked, leaf, "churn"), ["a"]).collect()] == [0.0]
    split = trees.tree_table(spark, [(0, None, None, "a", 5.0, 0), (1, 0, "<=", None, None, 0), (2, 0, ">", None, None, 1)])
    walked = trees.paths(rows, split, ["a"], depth=1)
    assert {r.id: r.camino for r in walked.collect()} == {1: [0, 2], 2: [0, 1]}
    counts = {r.nodo: (r.filas, r.gini) for r in trees.node_counts(walked, split, "churn").collect()}
    assert counts == {0: (2, 0.5), 1: (1, 0.0), 2: (1, 0.0)}
    assert trees.paths(rows.limit(0), split, ["a"], depth=1).count() == 0


def test_silhouette_equals_the_library(points):
    vectors = cluster.feature_vectors(points, FEATURES).withColumn("prediction", F.col("g").cast("double"))
    expected = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(vectors)
    (found,) = cluster.quality(points, "g", FEATURES).collect()
    assert found.silueta == pytest.approx(expected, abs=1e-9) and found.k == 3
    brute = 0.0
    for g in range(3):
        rows = [(r.a, r.b, r.c) for r in points.where(F.col("g") == g).collect()]
        centre = [sum(x) / len(rows) for x in zip(*rows, strict=True)]
        brute += sum((x - m) ** 2 for r in rows for x, m in zip(r, centre, strict=True))
    assert found.inercia == pytest.approx(brute, rel=1e-9)


def test_lone_clusters_have_no_silhouette(spark):
    rows = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 9.0)], "g INT, a DOUBLE")
    found = sorted(r.silueta for r in cluster.silhouette(rows, "g", ["a"]).collect())
    assert found[0] == 0.0 and found[1] > 0.9
    assert {r.silueta for r in cluster.silhouette(rows.where("g = 0"), "g", ["a"]).collect()} == {0.0}
    elbow = spark.createDataFrame([(2, 1.0, 0.5), (3, 0.5, 0.7), (4, 0.4, 0.7)], "k INT, inercia DOUBLE, silueta DOUBLE")
    assert tuple(cluster.best_k(elbow).first()) == (3, 0.7)


def _brute_rules(sets: dict) -> dict:
    found = {}
    for items, support in sets.items():
        for n in range(1, len(items)):
            for left in itertools.combinations(items, n):
                right = tuple(x for x in items if x not in left)
                if left in sets and right in sets and support / sets[left] / sets[right] >= 1:
                    found[left, right] = (support, sets[left], sets[right])
    return found


def test_rules_of_all_sizes(spark):
    draw = random.Random(8)
    sets = {c: draw.choice([0.25, 0.5, 0.75]) for n in range(1, 6) for c in itertools.combinations("abcde", n)}
    frame = spark.createDataFrame([(list(k), v) for k, v in sets.items()], "items ARRAY<STRING>, soporte DOUBLE")
    rules = basket.association_rules(frame).collect()
    found = {(tuple(r.antecedente), tuple(r.consecuente)): (r.soporte, r.soporte_a, r.soporte_c) for r in rules}
    assert found == _brute_rules(sets) and len(found) == len(rules)
    assert basket.association_rules(frame.limit(0)).count() == 0
    assert basket.association_rules(frame.where(F.size("items") == 1)).count() == 0


def test_one_frequent_set_of_22_items(spark):
    """No row lists the four million subsets of the set; its 44 rules come from the sets that are there."""
    items = [f"i{n:02}" for n in range(22)]
    sets = {tuple(items): 0.5} | {(x,): 0.6 for x in items}
    sets |= {tuple(x for x in items if x != left_out): 0.55 for left_out in items}
    frame = spark.createDataFrame([(list(k), v) for k, v in sets.items()], "items ARRAY<STRING>, soporte DOUBLE")
    rules = basket.association_rules(frame).collect()
    assert len(rules) == 44 and {len(r.consecuente) for r in rules} == {1, 21}


def test_short_labels_keep_the_order_of_the_sets(spark):
    frame = spark.createDataFrame([(["a", "b", "c"], 5, 0.5), (["a", "b"], 7, 0.7), (["d"], 7, 0.7)], basket.ITEMSETS)
    shown = [(r.etiqueta, r.num_items) for r in basket.top_itemsets(frame, first=2).collect()]
    assert shown == [("a, b", 2), ("d", 1), ("a, b", 3)]


def test_cube_levels_repeat_no_line(spark):
    draw = random.Random(1)
    names = "id_orden id_producto id_categoria categoria fecha_date anio mes trimestre cantidad subtotal descuento precio_unitario"
    rows = []
    for i in range(2000):
        order = draw.randrange(300)
        product = draw.randrange(60)
        category = None if product % 7 == 6 else product % 7
        month = order % 12 + 1
        rows.append((order, product, category, None if category is None else f"c{category}", date(2020 + order % 2, month, 3), 2020 + order % 2, month, (month + 2) // 3, draw.randrange(9), draw.random(), 0.1, 1.0))
    kinds = dict(zip(names.split(), "BIGINT BIGINT BIGINT STRING DATE INT INT INT BIGINT DOUBLE DOUBLE DOUBLE".split(), strict=True))
    base = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in kinds.items())).repartition(5)
    for level in (2, 3, 4):
        found = cube.cube_level(base, level)
        assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
        keys = cube.LEVELS[level]
        plain = base.na.drop(subset=keys).groupBy(*keys).agg(
            F.countDistinct("id_orden").alias("o"), F.countDistinct("id_producto").alias("p"), F.countDistinct("id_categoria").alias("c"), F.sum("cantidad").alias("q")
        )
        expected = {tuple(r[k] for k in keys): (r.o, r.q, {2: r.p, 4: r.c}.get(level)) for r in plain.collect()}
        own = {2: "productos_distintos", 4: "categorias_activas"}.get(level)
        assert {tuple(r[k] for k in keys): (r.transacciones, r.cantidad_vendida, r[own] if own else None) for r in found.collect()} == expected
    assert "Expand" not in cube.cube_grouping_sets(base)._jdf.queryExecution().executedPlan().toString()


def test_writes_measure_rows_keys_and_amounts(spark, tmp_path):
    frame = spark.createDataFrame([(1, 0.1), (None, 0.2), (3, None)], "id_x BIGINT, subtotal DOUBLE")
    found = write_measured(frame, str(tmp_path / "t"), key="id_x", amount="subtotal")
    assert tuple(found) == (3, 1, 0.3)
    assert write_measured(frame.limit(0), str(tmp_path / "e"), key="id_x", amount="subtotal").rows == 0
    log = load_measured(spark, {"a": frame, "b": spark.range(4)}, str(tmp_path / "all")).collect()
    assert {tuple(r) for r in log} == {("a", 3, 1, 0.3), ("b", 4, None, None)}


def test_catalog_lists_saved_tables_only(spark, tmp_path):
    frame = audit.commented(spark.range(3).withColumnRenamed("id", "id_a").withColumn("v", F.lit("x")), {"v": "un valor"})
    counts = save_all(spark, {"tabla_a": frame}, "prueba_catalogo", str(tmp_path / "db"))
    frame.createOrReplaceTempView("vista")
    try:
        listed = [tuple(r) for r in audit.catalog_listing(spark, "prueba_catalogo", counts).collect()]
    finally:
        spark.catalog.dropTempView("vista")
        spark.sql("DROP DATABASE prueba_catalogo CASCADE")
    assert listed == [("tabla_a", 1, "id_a", None, True, 3), ("tabla_a", 2, "v", "un valor", False, 3)]
