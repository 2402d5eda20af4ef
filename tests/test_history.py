from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.operators import joins, rfm, scd

PRODUCTS = "id_producto BIGINT, nombre_producto STRING, id_categoria BIGINT, nombre_categoria STRING, id_proveedor BIGINT, nombre_proveedor STRING, precio_unitario DOUBLE, costo_unitario DOUBLE, activo BOOLEAN"
HISTORY = "id_historico_precio BIGINT, id_producto BIGINT, precio BIGINT, costo BIGINT, fecha_inicio DATE, fecha_fin DATE"
OPEN = date(9999, 12, 31)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [(1, "a", 1, "C", 1, "P", 100.0, 40.0, True), (2, "b", 1, "C", 1, "P", 50.0, 20.0, False)], PRODUCTS
    )


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(
        [
            (1, 1, 110, 50, date(2023, 2, 1), date(2023, 6, 1)),
            (2, 1, 0, 50, date(2023, 6, 1), None),
            (3, 1, 130, 60, date(2024, 1, 1), None),
            (4, 1, 140, 70, date(2024, 1, 1), None),
        ],
        HISTORY,
    )


def test_compatible_product_versions(spark, products, history):
    found = scd.scd2_product(products, history).orderBy("id_producto_sk").collect()
    seen = [(r.id_producto_sk, r.id_producto_nk, r.precio_unitario, r.margen_pct, r.fecha_inicio, r.fecha_fin, r.es_actual) for r in found]
    assert seen == [
        (1, 1, 140.0, 50, date(2023, 1, 1), OPEN, 1),  # equal starts: the larger id is the latest
        (2, 2, 50.0, 60, date(2023, 1, 1), OPEN, 1),  # no history: list price
        (3, 1, 110.0, 55, date(2023, 2, 1), date(2023, 6, 1), 0),
        (4, 1, 0.0, 0, date(2023, 6, 1), date(2024, 1, 1), 0),  # free product; null end = latest start
        (5, 1, 130.0, 54, date(2024, 1, 1), date(2024, 1, 1), 0),
    ]


def test_strict_product_versions(spark, products, history):
    found = scd.scd2_product(products, history, strict=True).orderBy("id_producto_sk").collect()
    seen = [(r.id_producto_nk, r.precio_unitario, r.fecha_inicio, r.fecha_fin) for r in found]
    assert seen == [
        (1, 140.0, date(2024, 1, 1), OPEN),
        (2, 50.0, date(2023, 1, 1), OPEN),
        (1, 110.0, date(2023, 2, 1), date(2023, 6, 1)),
        (1, 0.0, date(2023, 6, 1), date(2024, 1, 1)),
        (1, 130.0, date(2024, 1, 1), date(2024, 1, 1)),
    ]


def test_current_price(spark, products, history, rows):
    assert rows(scd.price_current(products, history), "id_producto", "precio", "costo") == [(1, 140.0, 70.0), (2, 50.0, 20.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 900)), min_size=1, max_size=40, unique=True))
def test_validity_is_the_next_start(spark, changes):
    data = [(i, p, date(2020, 1, 1) + timedelta(days=d)) for i, (p, d) in enumerate(changes)]
    df = spark.createDataFrame(data, "id_historico_precio BIGINT, id_producto BIGINT, fecha_inicio DATE")
    found = {r.id_historico_precio: r.fecha_fin for r in scd.price_validity(df).collect()}
    for i, product, start in data:
        later = [s for _, p, s in data if p == product and s > start]
        assert found[i] == (min(later) if later else None)


def _customer_history(spark, strict):
    """Customer 1 goes A, A, B, A; customer 2 never buys."""
    cities = spark.createDataFrame([(1, "M", "R", "Z")], "id_ciudad BIGINT, nombre STRING, region STRING, zona STRING")
    customers = spark.createDataFrame(
        [(1, "x", "e", 1, date(2020, 1, 1), 30, "F"), (2, "y", "e", 1, date(2020, 1, 1), 30, "F")],
        "id_cliente BIGINT, nombre STRING, email STRING, id_ciudad BIGINT, fecha_registro DATE, edad INT, genero STRING",
    )
    orders = spark.createDataFrame(
        [(1, 1, datetime(2023, 1, 1)), (2, 1, datetime(2024, 5, 1))], "id_orden BIGINT, id_cliente BIGINT, fecha_orden TIMESTAMP_NTZ"
    )
    lines = spark.createDataFrame([(1, 10.9), (2, 5.0)], "id_orden BIGINT, subtotal DOUBLE")
    cutoffs = [date(2023, 6, 30), date(2023, 12, 31), date(2024, 3, 31), date(2024, 12, 31)]
    return scd.scd2_customer(customers, cities, orders, lines, cutoffs, strict=strict).orderBy("id_cliente_sk").collect()


@pytest.mark.parametrize("strict", [False, True])
def test_customer_versions_follow_segment_changes(spark, strict):
    found = _customer_history(spark, strict)
    seen = [(r.id_cliente_sk, r.id_cliente_nk, r.version, r.segmento_rfm, r.fecha_inicio, r.es_actual) for r in found]
    assert seen == [
        (1, 1, 1, "En riesgo", date(2023, 6, 30), 0),
        (2, 1, 2, "Perdido", date(2024, 3, 31), 0),
        (3, 1, 3, "En riesgo", date(2024, 12, 31), 1),
        (4, 2, 1, "Perdido", date(2023, 6, 30), 1),
    ]
    ends = [date(2024, 3, 31), date(2024, 12, 31), OPEN, OPEN] if strict else [OPEN] * 4
    assert [r.fecha_fin for r in found] == ends
    assert [r.monto_total for r in found] == [10, 10, 15, 0]


def test_audit_counts_versions(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 1)], "k BIGINT, es_actual INT")
    assert tuple(scd.scd_audit(df, "k", "d").head()) == ("d", 2, 3, 2, 1, 1)
    assert {r.k for r in scd.first_changed_key(df, "k").collect()} == {1}


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 400), st.integers(0, 200)), min_size=1, max_size=12),
    st.lists(st.integers(0, 600), min_size=1, max_size=20),
    st.sampled_from([1, 3, 64]),
)
def test_interval_join_equals_the_nested_loop(spark, windows, days, buckets):
    base = datetime(2021, 1, 20)
    wins = [(i, (base + timedelta(days=a)).date(), (base + timedelta(days=a + n)).date()) for i, (a, n) in enumerate(windows)]
    facts = [(i, base + timedelta(days=d, hours=i % 24)) for i, d in enumerate(days)]
    left = spark.createDataFrame(facts, "f BIGINT, t TIMESTAMP_NTZ")
    right = spark.createDataFrame(wins, "w BIGINT, a DATE, b DATE")
    found = sorted((r.f, r.w) for r in joins.interval_join(left, "t", right, "a", "b", buckets=buckets).collect())
    midnight = datetime.min.time()
    assert found == sorted(
        (f, w) for f, t in facts for w, a, b in wins if datetime.combine(a, midnight) <= t <= datetime.combine(b, midnight)
    )


def test_open_intervals(spark, rows):
    left = spark.createDataFrame([(1, datetime(2021, 3, 1)), (2, datetime(2020, 1, 1))], "f BIGINT, t TIMESTAMP_NTZ")
    right = spark.createDataFrame([(7, date(2021, 1, 1), None), (8, date(1900, 1, 1), date(9999, 12, 31))], "w BIGINT, a DATE, b DATE")
    assert rows(joins.interval_join(left, "t", right, "a", "b", open_end=True), "f", "w") == [(1, 7), (1, 8), (2, 8)]
    assert rows(joins.interval_join(left, "t", right, "a", "b"), "f", "w") == [(1, 8), (2, 8)]
    assert joins.interval_join(left.limit(0), "t", right, "a", "b", open_end=True).count() == 0


def test_a_hot_day_fills_no_bucket(spark):
    """95 % of the moments on one day, half of them at one instant: buckets stay near their equal share."""
    day = "timestampadd(DAY, cast(id % 1000 as int), timestamp_ntz'2020-01-01')"
    hot = "if(id % 2 = 0, timestamp_ntz'2021-05-05 12:00:00', timestampadd(SECOND, cast(id % 86400 as int), timestamp_ntz'2021-05-05'))"
    facts = spark.range(40_000).selectExpr("id as f", f"if(id % 20 = 7, {day}, {hot}) as t")
    windows = spark.createDataFrame([(1, date(2021, 5, 1), date(2021, 5, 9)), (2, date(2020, 1, 1), date(2020, 2, 1))], "w INT, a DATE, b DATE")
    joined = joins.interval_join(facts, "t", windows, "a", "b", buckets=32)
    expected = facts.join(windows, (F.col("a") <= F.col("t")) & (F.col("t") <= F.col("b"))).count()
    assert joined.count() == expected
    days = joins.day_buckets(facts, "t", 32)
    sized = facts.withColumn("_dia", F.to_date("t")).join(days, "_dia")
    part = F.pmod(F.xxhash64("f", "t"), F.col("_partes").cast("long"))
    sizes = [r["n"] for r in sized.groupBy("_cubeta", part.alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * 40_000 / 32 and len(sizes) >= 16


def test_a_month_of_changes_is_one_row(spark):
    data = [(i, 1, date(2020, 1 + i % 3, 1 + i // 3)) for i in range(60)] + [(99, 2, date(2020, 5, 5)), (98, 2, None)]
    df = spark.createDataFrame(data, "id BIGINT, p BIGINT, f DATE")
    arrays = joins.change_arrays(df, "p", "f", "id")
    assert sorted((r.p, len(r[joins.ROWS])) for r in arrays.collect()) == [(1, 20), (1, 20), (1, 20), (2, 1)]
    found = {r.id: r.fin for r in joins.next_start(df, "p", "f", "id", "fin").collect()}
    starts = sorted(f for _, p, f in data if p == 1)
    assert all(found[i] == next((s for s in starts if s > f), None) for i, p, f in data if p == 1)
    assert found[99] is None and 98 not in found


def test_snapshots_follow_the_newest_order(spark):
    orders = spark.createDataFrame([(1, 1, datetime(2005, 2, 3)), (2, 1, datetime(2005, 12, 31, 10))], "id_orden BIGINT, id_cliente BIGINT, fecha_orden TIMESTAMP_NTZ")
    ends = orders.select(rfm.half_year_ends(orders, date(2004, 1, 31)).alias("d")).first().d
    assert ends == [date(2004, 1, 31), date(2004, 6, 30), date(2004, 12, 31), date(2005, 6, 30), date(2005, 12, 31), date(2006, 6, 30)]
    lines = spark.createDataFrame([(1, 5.0), (2, 7.0)], "id_orden BIGINT, subtotal DOUBLE")
    customers = spark.createDataFrame([(1,)], "id_cliente BIGINT")
    seen = rfm.rfm_as_of(customers, orders, lines, rfm.half_year_ends(orders, date(2004, 1, 31))).orderBy("corte").collect()
    assert [(r.frecuencia, r.monto) for r in seen] == [(0, 0.0), (0, 0.0), (0, 0.0), (1, 5.0), (1, 5.0), (2, 12.0)]
    assert [r.corte for r in rfm.rfm_as_of(customers, orders.limit(0), lines, rfm.half_year_ends(orders.limit(0), date(2004, 1, 31))).collect()][:1] == [date(2004, 1, 31)]
