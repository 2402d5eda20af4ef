"""What the joins of the cube move, what its levels keep, and how many baskets are mined."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from vitrina.operators import cube
from vitrina.operators.mining import basket
from vitrina.plans import registry
from vitrina.plans.warehouse import STAR_TABLES
from vitrina.sinks import export_csv

FOLDER = "/root/testdata/sf0.001"

LINE = "id_orden BIGINT, id_producto BIGINT, id_categoria BIGINT, categoria STRING, fecha_date DATE, anio INT, mes INT, trimestre INT, cantidad BIGINT, subtotal DOUBLE, descuento DOUBLE, precio_unitario DOUBLE"


def _base(spark, keyless=False):
    draw, data = random.Random(3), []
    for _ in range(1500):
        order, product = draw.randrange(200), draw.randrange(30)
        category = None if product % 7 == 6 else product % 7
        month = order % 12 + 1
        name = None if category is None else f"c{category}"
        found = None if keyless and order % 10 == 0 else order
        data.append((found, product, category, name, date(2020 + order % 2, month, 3), 2020 + order % 2, month, (month + 2) // 3, draw.randrange(9), draw.choice([None, 1.25]), 0.1, 1.0))
    return spark.createDataFrame(data, LINE).repartition(5)


@pytest.mark.parametrize("name", ["cube_n0", "fact_sales"])
def test_joins_move_the_sources_of_amounts(spark, name):
    plan = registry.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"AS subtotal#", plan).start() < re.search(r"Join Inner, \(id_orden#", plan).start()


def test_level_1_counts_orders_by_marks(spark):
    base, keys = _base(spark, keyless=True), cube.LEVELS[1]
    level = cube.cube_level(base, 1)
    assert "count(distinct" not in level._jdf.queryExecution().optimizedPlan().toString()
    plain = base.na.drop(subset=keys).groupBy(*keys).agg(F.countDistinct("id_orden").alias("o"), F.sum("cantidad").alias("q"), F.sum("subtotal").alias("v"))
    expected = {tuple(r[k] for k in keys): (r.o, r.q, r.v or 0.0) for r in plain.collect()}
    assert {tuple(r[k] for k in keys): (r.transacciones, r.cantidad_vendida, r.ventas_totales) for r in level.collect()} == expected


def test_level_1_keeps_no_table_of_groups(spark):
    plan = registry.QUERIES["cube_n1"](spark, FOLDER)
    plan.collect()
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in shown and not re.search(r"HashAggregate\(keys=\[id_producto", shown)


def test_state_of_the_cube_is_one_row_per_category_and_month(spark):
    base = _base(spark, keyless=True)
    state = cube.cube_state(base)
    assert state.count() == base.select(*cube.STATE).distinct().count()
    known = base.na.drop(subset=cube.CATEGORY)
    years = {r.anio: r.o for r in known.groupBy("anio").agg(F.countDistinct("id_orden").alias("o")).collect()}
    together = cube.cube_grouping_sets(base, state).where("cubo_nivel = 4")
    assert {r.anio: r.transacciones for r in together.collect()} == years
    everything = {r.anio: r.o for r in base.groupBy("anio").agg(F.countDistinct("id_orden").alias("o")).collect()}
    assert {r.anio: r.transacciones for r in cube.cube_level(base, 4, state).collect()} == everything


def test_equal_baskets_are_mined_once(spark, monkeypatch):
    draw = random.Random(5)
    kinds = [sorted(draw.sample("abcdefg", draw.randrange(1, 6))) for _ in range(12)]
    orders = {i: kinds[draw.randrange(12)] for i in range(600)}
    pairs = spark.createDataFrame([(i, x) for i, items in orders.items() for x in items], "id_orden BIGINT, marca STRING")
    sizes = {}

    def measured(df, name="etapa"):
        out = df.localCheckpoint()
        sizes.setdefault(name, out.count())
        return out

    monkeypatch.setattr(basket, "stored", measured)
    found = basket.frequent_itemsets(pairs, 0.1, item="marca")
    counts = Counter(s for items in orders.values() for n in range(1, 8) for s in itertools.combinations(items, n))
    assert {tuple(r["items"]): r.frecuencia for r in found.collect()} == {s: n for s, n in counts.items() if n >= 60}
    assert sizes["canastas"] <= 12


def test_detail_of_the_cube_is_written_once(spark, monkeypatch):
    names, real = [], registry.stored
    monkeypatch.setattr(registry, "stored", lambda df, name="etapa": (names.append(name), real(df, name))[1])
    filas = {r.tabla: r.filas for r in registry.QUERIES["load_warehouse"](spark, FOLDER).collect()}
    assert "detalle_cubo" not in names and filas["Cubo_Ventas_N0"] == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()


def test_export_leaves_no_second_copy_of_the_star(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(registry, "scratch_path", lambda _, name: str(tmp_path / name))
    log = registry.QUERIES["sink_csv_export"](spark, FOLDER).collect()
    assert {p.name for p in tmp_path.iterdir()} == {"campanas", "export"}
    assert [r.tabla for r in log] == STAR_TABLES and not any(r.error for r in log)

    # The files hold what an export of the stored star holds.
    star = registry.warehouse(spark, FOLDER)
    star.load(str(tmp_path / "dw"))
    assert star.export(str(tmp_path / "again"), str(tmp_path / "dw")).collect() == log
    for name, count, _ in log:
        found = rows(spark.read.option("header", True).csv(str(tmp_path / "export" / name)))
        assert len(found) == count
        assert found == rows(spark.read.option("header", True).csv(str(tmp_path / "again" / name)))


def test_export_logs_the_rows_of_its_files(spark, tmp_path):
    """A table that differs from run to run shows that the rows written are the rows counted."""
    drawn = F.udf(lambda _: random.random(), "double").asNondeterministic()
    tables = {
        "drawn": lambda: spark.range(5000).where(drawn("id") < 0.5),
        "none": lambda: spark.range(0),
        "left_out": lambda: spark.range(9).where("id < 0"),
    }
    log = {r.tabla: (r.filas, r.error) for r in export_csv(spark, tables, str(tmp_path)).collect()}
    assert log == {name: (spark.read.schema("id BIGINT").option("header", True).csv(str(tmp_path / name)).count(), None) for name in tables}
    assert log["drawn"][0] > 0
