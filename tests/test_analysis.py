from __future__ import annotations

from datetime import date, datetime, timedelta
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vitrina.operators import cube, kpi, olap
from vitrina.operators.mining import basket, churn, cluster, correlation, metrics, returns, seasonality

SALES = "anio INT, mes INT, trimestre INT, nombre_mes STRING, nombre_categoria STRING, id_orden BIGINT, id_producto BIGINT, cantidad BIGINT, subtotal DOUBLE, margen_pct INT"


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [
            (2019, 1, 1, "January", "A", 1, 1, 1, 100.0, 50),
            (2019, 4, 2, "April", "B", 1, 2, 2, 50.0, 5),
            (2021, 1, 1, "January", "A", 2, 1, 3, 300.5, 50),
            (2022, 1, 1, "January", "A", 3, 3, 1, 150.0, 20),
        ],
        SALES,
    )


def test_growth_compares_neighbours_and_calendar_years(sales, rows):
    assert rows(kpi.yoy(sales), "anio", "crecimiento_yoy_pct", "banda") == [
        (2019, None, "neutro"), (2021, 100.3, "meta"), (2022, -50.1, "alerta"),
    ]
    same = {(r.anio, r.mes): r.crecimiento for r in kpi.yoy_same_period(sales).collect()}
    assert same[2021, 1] is None
    assert same[2022, 1] == pytest.approx((150 - 300.5) / 300.5)


def test_zero_base_year_gives_null(spark):
    df = spark.createDataFrame([(2020, 1, 0.0, 1), (2021, 1, 5.0, 2)], "anio INT, mes INT, subtotal DOUBLE, id_orden BIGINT")
    assert {r.anio: r.crecimiento_yoy_pct for r in kpi.yoy(df).collect()} == {2020: None, 2021: None}
    assert {r.anio: r.crecimiento for r in kpi.yoy_same_period(df).collect()} == {2020: None, 2021: None}


def test_margin_and_summary(sales, rows):
    margins = kpi.margin_by_category(sales)
    assert rows(margins, "nombre_categoria", "ingresos", "costo_estimado", "margen_real_pct", "banda") == [
        ("A", 550.5, 320.25, 41.8, "meta"), ("B", 50.0, 47.5, 5.0, "critico"),
    ]
    found = kpi.summary(kpi.yoy(sales), margins).head()
    assert (found.mejor_categoria, found.mejor_margen_pct, found.peor_categoria, found.peor_margen_pct) == ("A", 41.8, "B", 5.0)
    assert found.crecimiento_medio_pct == pytest.approx(25.1)


def test_summary_from_one_join_keeps_lines_of_unknown_products_in_the_growth(spark):
    fact = spark.createDataFrame(
        [(2020, 1, 100.0), (2020, 2, 50.0), (2021, 1, 200.0), (2021, 9, 100.0)], "anio INT, id_producto BIGINT, subtotal DOUBLE"
    )
    products = spark.createDataFrame([(1, "A", 40), (2, "B", 5)], "id_producto BIGINT, nombre_categoria STRING, margen_pct INT")
    found = kpi.summary_of_sums(kpi.year_category_sums(fact, products)).head()
    assert (found.crecimiento_medio_pct, found.margen_medio_pct) == (100.0, 22.5)
    assert (found.mejor_categoria, found.mejor_margen_pct, found.peor_categoria, found.peor_margen_pct) == ("A", 40.0, "B", 5.0)


def test_olap_shapes(sales, rows):
    assert rows(olap.slice_(sales, "nombre_categoria", "A"), "anio", "ventas") == [(2019, 100.0), (2021, 300.5), (2022, 150.0)]
    assert rows(olap.dice(sales, {"nombre_categoria": "A", "anio": 2021}), "nombre_mes", "cantidad") == [("January", 3)]
    drilled = olap.drilldown(sales, "nombre_categoria", "A")
    assert rows(drilled, "anio", "trimestre", "January", "April") == [(2019, 1, 100, 0), (2021, 1, 300, 0), (2022, 1, 150, 0)]
    pivot = {r.nombre_categoria: r for r in olap.pivot(sales).collect()}
    assert pivot["B"].trimestre_2 == 50 / 1e6
    assert pivot["B"].trimestre_3 == 0.0
    series = olap.monthly_series(olap.rollup(sales))
    assert rows(series, "periodo", "ventas")[0] == ("2019-01", 100.0)
    assert rows(olap.top_by_sales(sales, ["id_producto"], 1), "id_producto") == [(1,)]


@pytest.fixture(scope="module")
def detail(spark):
    day = lambda n: datetime(2023, 1, 1) + timedelta(days=n)
    lines = [(i, i // 3, i % 5, 1, 1, 1, 1, 1 + i % 4, 10.0 + i, 0.01 * (i % 7), 7.25 * (i + 1)) for i in range(60)]
    lines = spark.createDataFrame(lines, "id_detalle BIGINT, id_orden BIGINT, id_producto BIGINT, id_cliente BIGINT, id_empleado BIGINT, id_tienda BIGINT, id_metodo_pago BIGINT, cantidad BIGINT, precio_unitario DOUBLE, descuento DOUBLE, subtotal DOUBLE")
    orders = spark.createDataFrame([(o, day(o * 40), "Completada") for o in range(20)], "id_orden BIGINT, fecha_orden TIMESTAMP_NTZ, estado STRING")
    products = spark.createDataFrame([(p, 1 + p % 2) for p in range(4)], "id_producto BIGINT, id_categoria BIGINT")
    categories = spark.createDataFrame([(1, "A"), (2, "B")], "id_categoria BIGINT, nombre STRING")
    return cube.cube_base(lines, orders, products, categories)


def test_cube_levels_agree(detail):
    # Product 4 has no category: its lines are in the detail, and in no category group.
    found = {r.nivel: (r.filas, r.ventas_totales) for r in cube.cube_reconcile(detail).collect()}
    everything = sum(7.25 * (i + 1) for i in range(60))
    known = sum(7.25 * (i + 1) for i in range(60) if i % 5 != 4)
    assert found[0] == (60, everything)
    assert found[4][1] == everything
    assert found[1][1] == found[2][1] == found[3][1] == known


def test_reconcile_of_large_amounts(detail):
    found = {r.nivel: r.ventas_totales for r in cube.cube_reconcile(detail.withColumn("subtotal", F.col("subtotal") * 1e13)).collect()}
    assert found[0] == found[4] == 1e13 * sum(7.25 * (i + 1) for i in range(60))


def test_grouping_sets_equal_the_single_levels(detail, rows):
    known = detail.where("id_categoria IS NOT NULL")
    together = cube.cube_grouping_sets(known)
    for level, keys in cube.LEVELS.items():
        columns = [*keys, "cantidad_vendida", "ventas_totales", "descuento_total", "transacciones", "ticket_promedio"]
        assert rows(together.where(F.col("cubo_nivel") == level), *columns) == rows(cube.cube_level(known, level), *columns)


def test_results_do_not_depend_on_partitions(spark, detail, rows):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in (1, 4, 17):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(rows(cube.cube_level(detail.repartition(n), 2)))
        assert found[0] == found[1] == found[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- series -----------------------------------------------------------------------


def _weekly(spark, weeks):
    rows = [(d, 1.0 * n, n) for n, d in enumerate(weeks, 1)]
    return spark.createDataFrame(rows, "fecha_orden DATE, subtotal DOUBLE, id_orden BIGINT").withColumn(
        "fecha_orden", F.col("fecha_orden").cast("timestamp_ntz")
    )


def test_empty_weeks_are_kept(spark, rows):
    weekly = seasonality.weekly_sales(_weekly(spark, [date(2023, 1, 1), date(2023, 1, 18), date(2023, 1, 19)]))
    assert rows(weekly, "i", "semana_fin", "ventas", "transacciones") == [
        (0, date(2023, 1, 1), 1.0, 1), (1, date(2023, 1, 8), 0.0, 0), (2, date(2023, 1, 15), 0.0, 0), (3, date(2023, 1, 22), 5.0, 2),
    ]


def test_decomposition_equals_the_convolution(spark):
    period, n = 4, 19
    x = np.array([10 + i + [3, -1, 0, -2][i % 4] + 0.1 * (i * 7 % 5) for i in range(n)])
    weekly = spark.createDataFrame([("s", i, date(2023, 1, 1) + timedelta(weeks=i), float(v)) for i, v in enumerate(x)], "k STRING, i INT, semana_fin DATE, ventas DOUBLE")
    found = seasonality.seasonal_decompose(weekly, ["k"], period=period).orderBy("i").collect()
    weights = np.array([0.5, 1, 1, 1, 0.5]) / period
    trend = np.full(n, np.nan)
    trend[2:-2] = np.convolve(x, weights, "valid")
    means = np.array([np.nanmean((x - trend)[p::period]) for p in range(period)])
    seasonal = np.array([(means - means.mean())[i % period] for i in range(n)])
    assert [r.tendencia is None for r in found] == list(np.isnan(trend))
    for r, t, s, v in zip(found, trend, seasonal, x, strict=True):
        assert r.estacional == pytest.approx(s)
        if r.tendencia is not None:
            assert r.tendencia == pytest.approx(t)
            assert r.tendencia + r.estacional + r.residuo == pytest.approx(v)


def test_short_series_is_an_error(spark):
    weekly = seasonality.weekly_sales(_weekly(spark, [date(2023, 1, 1), date(2023, 3, 1)]))
    with pytest.raises(PySparkException, match="at least 104 points, found 10"):
        seasonality.seasonal_decompose(weekly).collect()


def test_constant_series_has_no_correlation(spark):
    star = spark.createDataFrame(
        [(2020, m, c, v) for m in range(1, 6) for c, v in (("A", float(m * m)), ("B", 3.0), ("C", -1.0 * m))],
        "anio INT, mes INT, nombre_categoria STRING, subtotal DOUBLE",
    )
    names = spark.createDataFrame([("A",), ("B",), ("C",)], "nombre STRING")
    pairs = correlation.correlation_matrix(correlation.monthly_cells(correlation.monthly_sales(star), names))
    found = {(r.a, r.b): r.correlacion for r in pairs.collect()}
    a, c = [m * m for m in range(1, 6)], [-m for m in range(1, 6)]
    assert found["A", "C"] == pytest.approx(np.corrcoef(a, c)[0][1])
    assert found["A", "B"] is None and found["B", "C"] is None and found["B", "B"] is None
    assert found["A", "A"] == pytest.approx(1)
    assert correlation.top_correlations(pairs, n=1).head().columna == "A"


# --- baskets ----------------------------------------------------------------------


@settings(max_examples=4, deadline=None)
@given(st.lists(st.sets(st.sampled_from("abcde"), min_size=1), min_size=3, max_size=14), st.sampled_from([0.2, 0.34, 0.5]))
def test_itemsets_and_rules_equal_brute_force(spark, orders, support):
    pairs = spark.createDataFrame([(o, i) for o, items in enumerate(orders) for i in items], "id_orden BIGINT, id_producto STRING")
    sets = basket.frequent_itemsets(basket.basket_items(pairs), support)
    found = {tuple(r["items"]): r.frecuencia for r in sets.collect()}
    n = len(orders)
    expected = {}
    for size in range(1, 6):
        for c in combinations("abcde", size):
            count = sum(set(c) <= o for o in orders)
            if count and count / n >= support - 1e-12:
                expected[c] = count
    assert found == expected
    rules = {
        (tuple(r.antecedente), tuple(r.consecuente)): (r.confianza, r.lift) for r in basket.association_rules(sets, 1.0).collect()
    }
    wanted = {}
    for s, count in expected.items():
        for size in range(1, len(s)):
            for a in combinations(s, size):
                k = tuple(x for x in s if x not in a)
                confidence = (count / n) / (expected[a] / n)
                lift = confidence / (expected[k] / n)
                if abs(lift - 1) > 1e-9:
                    if lift >= 1:
                        wanted[a, k] = (confidence, lift)
                elif (a, k) in rules:  # a lift of exactly one may round to either side
                    wanted[a, k] = rules[a, k]
    assert set(rules) == set(wanted)
    for key, values in wanted.items():
        assert rules[key] == pytest.approx(values)


def test_empty_basket_table(spark):
    empty = spark.createDataFrame([], "id_orden BIGINT, id_producto STRING")
    assert basket.frequent_itemsets(empty).count() == 0


def test_sample_is_stable(spark, rows):
    ids = spark.range(900).withColumnRenamed("id", "id_orden")
    a, b = (rows(basket.basket_sample(ids.repartition(n))) for n in (1, 9))
    assert a == b and len(a) == 500
    assert basket.basket_sample(ids.where("id_orden < 20")).count() == 20


# --- models -----------------------------------------------------------------------


def test_metrics_equal_hand_computation(spark, rows):
    scored = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 0)] * 4 + [(0, 1)], "y INT, p INT")
    assert rows(metrics.confusion_matrix(scored, "y", "p")) == [(0, 0, 4), (0, 1, 1), (1, 0, 2), (1, 1, 3)]
    report = {r.clase: r for r in metrics.classification_metrics(scored, "y", "p").collect()}
    assert report["1"].precision == pytest.approx(0.75)
    assert report["1"].recall == pytest.approx(0.6)
    assert report["accuracy"].f1 == pytest.approx(0.7)
    assert report["macro avg"].recall == pytest.approx(0.7)
    assert report["weighted avg"].soporte == 10


def test_metrics_of_a_class_that_never_occurs(spark):
    scored = spark.createDataFrame([(0, 0)] * 3, "y INT, p INT")
    report = {r.clase: r for r in metrics.classification_metrics(scored, "y", "p").collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].f1, report["1"].soporte) == (0.0, 0.0, 0.0, 0)


def test_bayes_equals_the_formula(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (30, 2)), rng.normal(2, 2, (20, 2))])
    y = np.array([0] * 30 + [1] * 20)
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))], "id INT, a DOUBLE, b DOUBLE, y INT")
    model = returns.fit_bayes(df, ["a", "b"], "y")
    found = {r.id: r for r in returns.predict_bayes(df, model, ["a", "b"]).collect()}
    extra = 1e-9 * x.var(axis=0).max()
    score = np.stack(
        [
            np.log((y == c).mean())
            - 0.5 * (np.log(2 * np.pi * (x[y == c].var(axis=0) + extra)) + (x - x[y == c].mean(axis=0)) ** 2 / (x[y == c].var(axis=0) + extra)).sum(axis=1)
            for c in (0, 1)
        ]
    )
    assert [found[i].prediccion for i in range(50)] == list(score.argmax(axis=0))
    posterior = np.exp(score - score.max(axis=0)).sum(axis=0) ** -1
    assert [found[i].probabilidad for i in range(50)] == pytest.approx(list(posterior))


def test_risk_score_and_noise(spark):
    df = spark.createDataFrame([(1, "Gaming", 600_000.0), (2, "Audio", 10.0)], "id_producto BIGINT, nombre_categoria STRING, precio_promedio DOUBLE")
    assert [r.prob_devolucion for r in returns.risk_score(df).collect()] == [0.3, 0.05]
    noisy = [r.prob_devolucion for r in returns.risk_score(df, noise_seed=1).collect()]
    assert 0.25 <= noisy[0] <= 0.35 and 0.01 <= noisy[1] <= 0.1
    assert noisy == [r.prob_devolucion for r in returns.risk_score(df.repartition(3), noise_seed=1).orderBy("id_producto").collect()]


@pytest.fixture(scope="module")
def customers(spark):
    data = [(i, 20 * (i % 4) + i % 3, 40 - 10 * (i % 4) + i % 2, 100_000 * (4 - i % 4) + i) for i in range(80)]
    return spark.createDataFrame(data, "id_cliente BIGINT, recency BIGINT, frecuencia BIGINT, monto_total BIGINT")


def test_clusters_are_numbered_by_amount(customers):
    found = cluster.profile(cluster.segments(customers, 4)).orderBy("cluster").collect()
    assert [r.clientes for r in found] == [20] * 4
    assert [r.monto_total_media for r in found] == sorted((r.monto_total_media for r in found), reverse=True)


def test_elbow_finds_the_real_clusters(customers):
    table = cluster.elbow(customers, ks=range(2, 6), restarts=2)
    inertia = [r.inercia for r in table.orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)
    assert cluster.best_k(table).head().k == 4


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a DOUBLE, b DOUBLE")
    assert [tuple(r) for r in cluster.standardize(df, ["a", "b"]).select("a_z", "b_z").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_churn_models(spark):
    data = [(i, (i * 37) % 400, i % 13, i * 11 % 977, 0.01 * (i % 20), i % 700, int((i * 37) % 400 > 180)) for i in range(400)]
    features = spark.createDataFrame(data, "id_cliente BIGINT, recency BIGINT, frecuencia BIGINT, monto_total BIGINT, tasa_devolucion DOUBLE, dias_desde_registro BIGINT, churn INT")
    frame = churn.training_frame(features)
    model = churn.fit_on_train(churn.forest(trees=10), frame)
    scored = churn.test_predictions(model, frame)
    assert scored.where("churn = prediccion").count() / scored.count() > 0.95
    ranking = [r.feature for r in churn.importance(model, churn.feature_list(), frame).collect()]
    assert ranking[0] == "recency"
    tree = churn.fit_on_train(churn.tree(), frame)
    assert any("recency" in r.regla for r in churn.tree_rules(tree, churn.feature_list(), frame).collect())
    assert churn.cross_validate(churn.tree(), frame, "churn", "id_cliente").head().exactitud_media > 0.95
    assert churn.feature_list(exclude_leaky=True) == ["frecuencia", "monto_total", "tasa_devolucion", "dias_desde_registro"]
    train = frame.where("es_entrenamiento")
    weights = {r.churn: r.peso for r in churn.with_balanced_weight(train, "churn").select("churn", "peso").distinct().collect()}
    assert weights[1] == pytest.approx(train.count() / (2 * train.where("churn = 1").count()))


def test_folds_are_stratified(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    found = churn.with_fold(df, "k", "y").groupBy("y", "fold").count().collect()
    for label, size in ((0, 902), (1, 101)):
        assert sorted(r["count"] for r in found if r.y == label) == sorted(size // 5 + (i < size % 5) for i in range(5))
    again = churn.with_fold(df.repartition(7), "k", "y")
    assert again.exceptAll(churn.with_fold(df, "k", "y")).isEmpty()
