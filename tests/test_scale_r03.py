from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from vitrina.operators import joins, orders, scd
from vitrina.operators.mining import churn, cluster
from vitrina.plans import registry


# --- models after a measured write ------------------------------------------------


def test_forests_predict_in_a_session_that_observed_a_metric(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    data = [(i, i % 400, i % 7, i % 11, 0.1, i % 50, int(i % 400 > 180)) for i in range(400)]
    features = spark.createDataFrame(data, "id_cliente BIGINT, recency BIGINT, frecuencia BIGINT, monto_total BIGINT, tasa_devolucion DOUBLE, dias_desde_registro BIGINT, churn INT")
    frame = churn.training_frame(features)
    scored = churn.test_predictions(churn.fit_on_train(churn.forest(trees=5), frame), frame)
    assert scored.where("churn = prediccion").count() == frame.where("NOT es_entrenamiento").count()
    assert churn.cross_validate(churn.forest(trees=5), frame, "churn", "id_cliente", folds=2).head().exactitud_media > 0.95


# --- promotions -------------------------------------------------------------------


def _orders_and_promotions(spark):
    base = datetime(2021, 1, 1)
    sold = [(i, base + timedelta(days=i * 7 % 90, hours=i % 24)) for i in range(300)] + [(999, None)]
    offers = [(i, "Fijo", i, (base + timedelta(days=i * 5 % 120)).date(), (base + timedelta(days=i * 5 % 120 + i % 9)).date() if i % 10 else None, i % 4 != 0) for i in range(60)]
    offers.append((60, "Fijo", 1, date(1900, 1, 1), date(9999, 12, 31), True))
    return (
        spark.createDataFrame(sold, "id_orden BIGINT, fecha_orden TIMESTAMP_NTZ"),
        spark.createDataFrame(offers, "id_promocion BIGINT, tipo STRING, valor BIGINT, fecha_inicio DATE, fecha_fin DATE, activa BOOLEAN"),
    )


def test_intervals_meet_the_facts_of_their_days_only(spark):
    sold, offers = _orders_and_promotions(spark)
    dealt, repeated = joins.met_by_day(sold, "fecha_orden", offers.where("activa"), "fecha_inicio", "fecha_fin", open_end=True, buckets=4)
    candidates = dealt.join(repeated, joins.MEETING)
    found = joins.interval_join(sold, "fecha_orden", offers.where("activa"), "fecha_inicio", "fecha_fin", open_end=True, buckets=4)
    tested, matched = candidates.count(), found.count()
    nested = sold.join(offers.where("activa"), F.expr("fecha_inicio <= fecha_orden AND (fecha_orden <= fecha_fin OR fecha_fin IS NULL)"))
    assert matched == nested.count()
    # Only an interval's last day holds facts that do not match; runs of days tested several times as many.
    last_days = candidates.where("to_date(fecha_orden) = fecha_fin").count()
    assert tested <= matched + last_days


def test_chosen_promotion_equals_the_minimum_over_all_pairs(spark, rows, monkeypatch):
    sold, offers = _orders_and_promotions(spark)
    expected = rows(orders.one_promotion_per_order(orders.active_promotions(sold, offers)))
    assert len(expected) == 300
    assert rows(orders.chosen_promotion(sold, offers)) == expected
    monkeypatch.setattr(orders, "LISTED", 7)
    assert rows(orders.chosen_promotion(sold.repartition(5), offers)) == expected


# --- history ----------------------------------------------------------------------


def test_audit_of_histories_numbers_and_stores_nothing(spark, monkeypatch):
    def numbered(*_):
        raise AssertionError("the audit needs no surrogate keys")

    monkeypatch.setattr(scd, "dense_keys", numbered)
    found = {r.dimension: r for r in registry.QUERIES["scd_audit"](spark, "/root/testdata/sf0.001").collect()}
    assert set(found) == {"producto", "cliente"}
    assert all(r.versiones == r.actuales + r.historicas > r.claves > 0 for r in found.values())


# --- clusters ---------------------------------------------------------------------


def test_clusters_are_fitted_on_distinct_points_with_their_customers(spark):
    data = [(i, float(i % 10 // 5 * 100 + i % 5), 1.0) for i in range(200)]
    points = spark.createDataFrame(data, "id INT, a DOUBLE, b DOUBLE")
    weighted = cluster.weighted_vectors(points, ["a", "b"])
    assert sorted(r.peso for r in weighted.collect()) == [20.0] * 10
    model = cluster.fit_best(weighted, 2, restarts=2, weight=cluster.WEIGHT)
    assert model.summary.trainingCost == pytest.approx(200 * 2.0)
    assert sorted(tuple(c) for c in model.clusterCenters()) == [(2.0, 1.0), (102.0, 1.0)]
