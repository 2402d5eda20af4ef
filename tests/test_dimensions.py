from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vitrina.operators import dimensions, keys, rfm
from vitrina.operators.facts import sales_fact, star

ORDERS = "id_orden BIGINT, id_cliente BIGINT, id_empleado BIGINT, id_tienda BIGINT, id_metodo_pago BIGINT, fecha_orden TIMESTAMP_NTZ, estado STRING"
LINES = "id_detalle BIGINT, id_orden BIGINT, id_producto BIGINT, cantidad BIGINT, precio_unitario DOUBLE, descuento DOUBLE, subtotal DOUBLE, devuelto BOOLEAN"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 10, 1, 1, 1, datetime(2023, 1, 1, 10), "Completada"),
            (2, 10, 1, 2, 1, datetime(2023, 1, 5, 9), "Cancelada"),
            (3, 11, 1, 1, 2, datetime(2023, 1, 3, 0), "Completada"),
            (4, None, 1, 1, 2, datetime(2023, 1, 4, 0), "Completada"),
        ],
        ORDERS,
    )


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [(1, 1, 100, 2, 5.0, 0.1, 9.0, False), (2, 1, 101, 1, 7.5, 0.0, 7.5, True), (3, 2, 100, 1, 5.0, 0.0, 5.0, False)],
        LINES,
    )


def test_calendar_covers_every_day(spark, orders):
    days = dimensions.calendar_dim(orders, "fecha_orden").orderBy("id_tiempo").collect()
    assert [d.id_tiempo for d in days] == [1, 2, 3, 4, 5]
    assert [d.fecha for d in days] == [date(2023, 1, n) for n in range(1, 6)]
    first = days[0]
    assert (first.semana, first.dia_semana, first.es_fin_semana, first.nombre_dia, first.nombre_mes) == (
        52, 6, True, "Sunday", "January",
    )


def test_customer_without_orders_and_order_without_lines(spark, orders, lines):
    customers = spark.createDataFrame([(10, "a", 1), (11, "b", 1), (12, "c", 1), (13, "d", 9)], "id_cliente BIGINT, nombre STRING, id_ciudad BIGINT")
    cities = spark.createDataFrame([(1, "M", "R", "Z")], "id_ciudad BIGINT, nombre STRING, region STRING, zona STRING")
    found = {r.id_cliente: r for r in dimensions.customer_dim(customers, cities, orders, lines).collect()}
    assert set(found) == {10, 11, 12}  # the city of 13 is unknown
    assert (found[10].recency, found[10].frecuencia, found[10].monto_total) == (0, 2, 21)
    assert (found[11].recency, found[11].frecuencia, found[11].monto_total) == (2, 1, 0)
    assert (found[12].recency, found[12].frecuencia, found[12].monto_total) == (999, 0, 0)
    assert found[12].segmento_rfm == "Perdido"
    assert found[12].monetario is None


def test_null_customer_forms_no_group(spark, orders):
    assert {r.id_cliente for r in rfm.rfm_base(orders).collect()} == {10, 11}


def test_amount_per_customer(spark, orders, lines, rows):
    out = rfm.customer_monetary(rfm.rfm_base(orders), orders, lines)
    assert rows(out, "id_cliente", "monto_total") == [(10, 21.5), (11, 0.0)]


@pytest.mark.parametrize("zone", ["UTC", "America/Bogota", "Asia/Tokyo"])
def test_as_of_equals_the_definition(spark, orders, lines, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _check_as_of(spark, orders, lines)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _check_as_of(spark, orders, lines):
    customers = spark.createDataFrame([(10,), (11,), (12,)], "id_cliente BIGINT")
    cutoffs = [date(2023, 1, 1), date(2023, 1, 3), date(2023, 1, 5), date(2023, 1, 6)]
    found = {(r.id_cliente, r.corte): (r.recency, r.frecuencia, r.monto) for r in rfm.rfm_as_of(customers, orders, lines, cutoffs).collect()}
    sums = {1: 16.5, 2: 5.0}
    for customer in (10, 11, 12):
        for cutoff in cutoffs:
            midnight = datetime.combine(cutoff, datetime.min.time())
            seen = [o for o in orders.collect() if o.id_cliente == customer and o.fecha_orden <= midnight]
            expected = (
                ((midnight - max(o.fecha_orden for o in seen)).days, len(seen), sum(sums.get(o.id_orden, 0.0) for o in seen))
                if seen
                else (999, 0, 0.0)
            )
            assert found[customer, cutoff] == expected
    assert found[10, date(2023, 1, 1)] == (999, 0, 0.0)  # the order at ten o'clock is after the cutoff


def test_employee_join_types(spark, rows):
    employees = spark.createDataFrame([(1, "a", "x", 1, date(2020, 1, 1), 1.0), (2, "b", "x", 9, date(2020, 1, 1), 1.0)], "id_empleado BIGINT, nombre STRING, cargo STRING, id_tienda BIGINT, fecha_contratacion DATE, salario DOUBLE")
    stores = spark.createDataFrame([(1, "T")], "id_tienda BIGINT, nombre STRING")
    assert rows(dimensions.employee_dim(employees, stores), "id_empleado", "nombre_tienda") == [(1, "T")]
    assert rows(dimensions.employee_dim(employees, stores, "left"), "id_empleado", "nombre_tienda") == [(1, "T"), (2, None)]


def test_supplier_union_numbers_internal_first(spark):
    own = spark.createDataFrame([(2, "b", "CO"), (1, "a", "CO")], "id_proveedor BIGINT, nombre STRING, pais STRING")
    other = spark.createDataFrame([(1, "x", "MX")], "id_proveedor_ext BIGINT, nombre_empresa STRING, pais STRING")
    found = dimensions.supplier_dim(own, other).orderBy("id_proveedor_dw").collect()
    assert [(r.id_proveedor_dw, r.nombre, r.tipo) for r in found] == [(1, "a", "Interno"), (2, "b", "Interno"), (3, "x", "Externo")]


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_dense_keys_follow_the_order(spark, partitions):
    # One value holds a third of the rows.
    df = spark.range(3000).select((F.col("id") % 3000).alias("id"), F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 50).alias("k"))
    found = keys.dense_keys(df.repartition(partitions), ["k", "id"], "sk").orderBy("sk").collect()
    assert [r.sk for r in found] == list(range(1, 3001))
    assert [(r.k, r.id) for r in found] == sorted((r.k, r.id) for r in found)


def test_label_codes(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("Z",), ("",), ("ab",), ("abc",), ("abd",)], "c STRING")
    found = rows(keys.dense_rank_of_values(df, "c", "n"), "c", "n")
    assert found == [("", 0), ("Z", 1), ("a", 2), ("ab", 3), ("abc", 4), ("abd", 5), ("b", 6)]


def test_many_labels_without_a_job_while_planning(spark):
    labels = [f"{i * 7919 % 20_000:05d}" for i in range(20_000)]
    df = spark.createDataFrame([(label,) for label in labels], "c STRING")
    spark.sparkContext.setJobGroup("plan", "labels")
    ranked = keys.dense_rank_of_values(df, "c", "n", start=1)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setJobGroup("run", "labels")
    assert ranked.where("n <> int(c) + 1").isEmpty() and ranked.count() == 20_000


def test_repeated_orders_count_once(spark, lines, orders):
    people = orders.select("id_cliente").distinct()
    cutoffs = [date(2030, 1, 1)]
    once = rfm.rfm_as_of(people, orders, lines, cutoffs)
    assert rfm.rfm_as_of(people, orders.union(orders), lines, cutoffs).exceptAll(once).isEmpty()


def test_fact_keeps_each_line_once_and_star_names_both_cities(spark, orders, lines, rows):
    calendar = dimensions.calendar_dim(orders, "fecha_orden")
    fact = sales_fact(lines, orders, calendar)
    assert rows(fact, "id_detalle", "id_tiempo", "id_tienda") == [(1, 1, 1), (2, 1, 1), (3, 5, 2)]
    shops = spark.createDataFrame([(1, "s", 1, "t", 5, "M", "R", "Z"), (2, "u", 1, "t", 5, "N", "R", "Z")], "id_tienda BIGINT, nombre_tienda STRING, id_ciudad BIGINT, tipo STRING, tamano_m2 BIGINT, nombre_ciudad STRING, region STRING, zona STRING")
    people = spark.createDataFrame([(10, "c", "VIP", "P", "R", "Z")], "id_cliente BIGINT, nombre_cliente STRING, segmento_rfm STRING, nombre_ciudad STRING, region STRING, zona STRING")
    wide = star(fact, calendar=calendar, customers=people, stores=shops)
    assert rows(wide, "id_detalle", "anio", "ciudad_cliente", "ciudad_tienda") == [(1, 2023, "P", "M"), (2, 2023, "P", "M"), (3, 2023, "P", "N")]
    taken = sales_fact(lines, orders, calendar, ["anio", "mes", "nombre_mes", "trimestre"])
    assert rows(taken, "id_detalle", "mes") == [(1, 1), (2, 1), (3, 1)]
