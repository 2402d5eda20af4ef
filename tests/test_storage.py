from __future__ import annotations

import os
from datetime import datetime
from types import SimpleNamespace

import pytest

from vitrina import session
from vitrina.operators import audit
from vitrina.sinks import export_csv, overwrite, reread_csv
from vitrina.sinks.writers import load_tables
from vitrina.sources import read_csv, read_table, read_xml
from vitrina.sources.schemas import CAMPAIGN, FILES


def test_xml_child_may_be_missing(spark, tmp_path):
    path = tmp_path / "c.xml"
    path.write_text(
        """<?xml version="1.0"?><campanas>
        <campana id="C1"><nombre>Día &amp; más</nombre><inicio>2024-11-25</inicio><presupuesto>5000</presupuesto></campana>
        <campana id="C2"><nombre>B</nombre><fin>2024-12-02</fin><incremento_ventas_pct>30</incremento_ventas_pct></campana>
        </campanas>""",
        encoding="utf-8",
    )
    found = read_xml(spark, str(path), "campana", CAMPAIGN).orderBy("id").collect()
    assert [(r.id, r.nombre, r.presupuesto, r.incremento_ventas_pct) for r in found] == [
        ("C1", "Día & más", 5000.0, None), ("C2", "B", None, 30.0),
    ]
    assert found[0].fin is None and str(found[1].fin) == "2024-12-02"


def test_csv_with_quotes_and_nulls(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(
        "id_promocion,nombre,tipo,valor,fecha_inicio,fecha_fin,categoria_aplica,activa\n"
        '31,Y,Prueba,7,2019-04-02,,"Mesas,Sillas",True\n',
        encoding="utf-8",
    )
    row = read_csv(spark, str(path), FILES["promociones"]).head()
    assert (row.categoria_aplica, row.fecha_fin, row.activa, row.valor) == ("Mesas,Sillas", None, True, 7)


def test_overwrite_replaces_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert overwrite(spark.range(10), path) == 10
    assert overwrite(spark.range(3), path) == 3
    assert read_table(spark, path, "id BIGINT", ["id"]).count() == 3


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    names = [f"b{os.getpid()}_{n}" for n in "xy"]
    for name in names:
        overwrite(spark.range(50).withColumnRenamed("id", "k"), str(tmp_path / name), table=name, bucket_by=(4, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table(names[0]).join(spark.table(names[1]), "k")
        assert joined.count() == 50
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert set(names) <= set(audit.catalog_tables(spark))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_one_bad_table_does_not_stop_the_export(spark, tmp_path):
    tables = {
        "bad": lambda: spark.read.parquet(str(tmp_path / "none")),
        "good": lambda: spark.createDataFrame([(1, "a,b", "x")], "id BIGINT, t STRING, fecha STRING"),
    }
    log = {r.tabla: r for r in export_csv(spark, tables, str(tmp_path / "out")).collect()}
    assert log["bad"].filas is None and log["bad"].error
    assert log["good"].filas == 1 and log["good"].error is None
    again = reread_csv(spark, str(tmp_path / "out" / "good"), ["id", "t", "fecha"]).head()
    assert tuple(again) == ("1", "a,b", None)


def test_dates_are_coerced_by_name(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-02", "2024-01-02")], "fecha_orden STRING, otra STRING")
    export_csv(spark, {"t": lambda: df}, str(tmp_path))
    row = reread_csv(spark, str(tmp_path / "t"), df.columns).head()
    assert tuple(row) == (datetime(2024, 1, 2), "2024-01-02")


def test_manifest_adds_up(spark, tmp_path):
    found = {r.tabla: r.filas for r in load_tables(spark, {"a": spark.range(2), "b": spark.range(5)}, str(tmp_path)).collect()}
    assert found == {"a": 2, "b": 5, "TOTAL": 7}


def test_relations_and_orphans(spark, rows):
    tables = {
        "ciudades": spark.createDataFrame([(1,), (2,)], "id_ciudad BIGINT"),
        "tiendas": spark.createDataFrame([(7, 1), (8, 3), (9, 3), (10, None)], "id_tienda BIGINT, id_ciudad BIGINT"),
    }
    assert audit.inferred_relations(tables) == [("tiendas", "id_ciudad", "ciudades")]
    assert rows(audit.fk_orphans(tables)) == [("tiendas", "id_ciudad", "ciudades", 2)]
    assert rows(audit.table_counts(tables, "TOTAL"), "tabla", "filas") == [("TOTAL", 6), ("ciudades", 2), ("tiendas", 4)]
    assert rows(audit.schema_listing(tables), "tabla", "posicion", "columna", "es_pk", "filas")[0] == ("ciudades", 1, "id_ciudad", True, 2)


def _session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
    )


def test_shared_folder_comes_from_the_session():
    first, second = (session.scratch_path(_session("spark://m:7077", "hdfs://h/ck/"), "t") for _ in range(2))
    assert first.startswith("hdfs://h/ck/vitrina/") and first != second


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(_session("spark://m:7077"))
    assert os.path.isdir(session.shared_root(_session("local[2]")))


def test_stored_frame_keeps_its_schema(spark):
    df = spark.createDataFrame([(1, [1.5]), (2, None)], "k BIGINT, v ARRAY<DOUBLE>")
    again = session.stored(df)
    assert again.schema == df.schema
    assert sorted(map(repr, again.collect())) == sorted(map(repr, df.collect()))


def test_export_goes_on_after_a_damaged_file(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    spark.range(4).write.parquet(good)
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    tables = {
        "bad": lambda: spark.read.schema("id BIGINT").parquet(str(bad)),
        "good": lambda: spark.read.parquet(good),
    }
    log = {row[0]: row for row in export_csv(spark, tables, str(tmp_path / "out")).collect()}
    assert log["good"][1] == 4 and log["bad"][1] is None and log["bad"][2]


def test_tables_are_chosen_by_name_and_prefix():
    tables = {"Dim_A": 1, "Dim_B": 2, "Cubo_A": 3}
    assert audit.selected(tables) == tables
    assert audit.selected(tables, exclude_prefixes=["Dim_"]) == {"Cubo_A": 3}
    assert audit.selected(tables, ["Dim_A", "Cubo_A", "Otra"], ["Cubo_"]) == {"Dim_A": 1}
