"""The registered queries: one callable (spark, folder) -> DataFrame per operator."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.measures import half_even
from vitrina.functions.rules import DIMENSION_RULE, SNAPSHOT_RULE
from vitrina.operators import audit, cube, dimensions, facts, kpi, olap, orders, rfm, scd
from vitrina.operators.mining import basket, churn, cluster, correlation, metrics, returns, seasonality, trees
from vitrina.plans import parameters as P
from vitrina.plans.warehouse import Warehouse, opened
from vitrina.session import configure, scratch_path, stored
from vitrina.sinks.writers import load_measured, load_tables, overwrite, reread_csv, save_all
from vitrina.sources.files import RetailFiles, write_files
from vitrina.sources.readers import read_csv, read_table, read_xml
from vitrina.sources.retail import Retail
from vitrina.sources.schemas import CAMPAIGN, CAMPAIGN_TAG, TABLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a query under its function name."""
    QUERIES[build.__name__] = lambda spark, folder: build(warehouse(spark, folder))
    return build


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    retail = Retail(configure(spark), folder)
    return Warehouse(retail, lambda: campaigns_from_xml(retail), DIMENSION_RULE.with_amount(P.VIP_AMOUNT))


def rounded(df: DataFrame, *columns: str, decimals: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})


# --- sources and sinks ------------------------------------------------------------


def campaign_source(retail: Retail) -> DataFrame:
    """One campaign per supplier; every fourth one has no end, so its element is missing."""
    key = F.col("s_suppkey")
    start = F.date_add(F.lit(P.FIRST_DAY), key.cast("int"))
    kinds = F.array(F.lit("Descuento"), F.lit("Online"), F.lit("Estacional"))
    return retail.raw("supplier").select(
        F.concat(F.lit("C"), F.lpad(key.cast("string"), 10, "0")).alias("_id"),
        F.concat(F.lit("Campaña & más "), "s_name").alias("nombre"),
        F.element_at(kinds, (key % 3 + 1).cast("int")).alias("tipo"),
        start.alias("inicio"),
        F.when(key % 4 != 0, F.date_add(start, 7)).alias("fin"),
        ((key % 50 + 1) * 1000).cast("double").alias("presupuesto"),
        F.lit("LARGE,PROMO").alias("categorias"),
        (key % 45).cast("double").alias("incremento_ventas_pct"),
    )


def campaigns_from_xml(retail: Retail) -> DataFrame:
    path = scratch_path(retail.spark, "campanas")
    source = campaign_source(retail).write.format("xml")
    source.options(rootTag="campanas", rowTag=CAMPAIGN_TAG).mode("overwrite").save(path)
    return read_xml(retail.spark, path, CAMPAIGN_TAG, CAMPAIGN)


@query
def src_table(w):
    return read_table(w.spark, f"{w.retail.path}/orders.parquet", TABLES["orders"])


@query
def src_pruned(w):
    columns = ["l_orderkey", "l_partkey", "l_quantity"]
    return read_table(w.spark, f"{w.retail.path}/lineitem.parquet", TABLES["lineitem"], columns)


@query
def src_csv_roundtrip(w):
    path = scratch_path(w.spark, "part")
    w.retail.raw("part").write.option("header", True).option("escape", '"').csv(path)
    return read_csv(w.spark, path, TABLES["part"])


@query
def src_xml(w):
    return campaigns_from_xml(w.retail)


@query
def sink_overwrite(w):
    """The second write replaces the first one."""
    path = scratch_path(w.spark, "Dim_Tienda")
    overwrite(w.stores.limit(0), path)
    overwrite(w.stores, path)
    return w.spark.read.parquet(path)


@query
def load_manifest(w):
    return w.load(scratch_path(w.spark, "dw"))


@query
def sink_csv_export(w):
    """Every table of the star as CSV files, written from its plan, with its rows."""
    return w.export(scratch_path(w.spark, "export"))


@query
def dates_coerced(w):
    """Export orders with some unreadable dates, read them back as text and coerce."""
    path = scratch_path(w.spark, "ordenes")
    text = F.when(F.col("estado") == "Cancelada", "sin fecha").otherwise(F.col("fecha_orden").cast("string"))
    columns = ["id_orden", "fecha_orden", "estado"]
    w.retail.orders.withColumn("fecha_orden", text).select(*columns).write.option("header", True).csv(path)
    return reread_csv(w.spark, path, columns).withColumn("id_orden", F.col("id_orden").cast("long"))


def operational_tables(retail: Retail) -> dict[str, DataFrame]:
    return {
        "categorias": retail.categories,
        "ciudades": retail.cities,
        "clientes": retail.customers,
        "detalleordenes": retail.order_lines,
        "empleados": retail.employees,
        "historicoprecios": retail.price_history,
        "metodospago": retail.payment_methods,
        "ordenes": retail.orders,
        "productos": retail.products,
        "proveedores": retail.suppliers,
        "tiendas": retail.stores,
    }


@query
def schema_listing(w):
    return audit.schema_listing(operational_tables(w.retail))


@query
def table_counts(w):
    return audit.table_counts(operational_tables(w.retail), "TOTAL")


@query
def fk_orphans(w):
    return audit.fk_orphans(operational_tables(w.retail))


# --- dimensions and fact ----------------------------------------------------------


@query
def dim_date(w):
    return w.calendar


@query
def dim_product(w):
    return w.products


@query
def rfm_base(w):
    return rfm.rfm_base(w.retail.orders)


@query
def customer_monetary(w):
    out = rfm.customer_monetary(rfm.rfm_base(w.retail.orders), w.retail.orders, w.retail.order_lines)
    return out.select("id_cliente", "monto_total")


@query
def dim_customer_rfm(w):
    return w.customers


@query
def dim_store(w):
    return w.stores


@query
def dim_employee(w):
    return w.employees


@query
def dim_payment(w):
    return w.payments


@query
def dim_supplier_union(w):
    return w.suppliers


@query
def dim_campaign(w):
    return w.campaigns


@query
def fact_sales(w):
    return w.fact.withColumn("subtotal_entero", half_even("subtotal").cast("long"))


@query
def star_join(w):
    out = w.star("calendar", "products", "customers", "stores")
    return out.select(
        "id_detalle", "id_orden", "id_producto", "id_cliente", "id_tienda", "anio", "mes", "trimestre",
        "nombre_categoria", "margen_pct", "segmento_rfm", "ciudad_cliente", "zona_cliente", "tipo_tienda",
        "ciudad_tienda", "zona_tienda", "cantidad", "subtotal",
    )


@query
def segment_counts(w):
    return rfm.segment_counts(w.customers)


# --- slowly changing dimensions ---------------------------------------------------


@query
def rfm_as_of(w):
    r = w.retail
    return rfm.rfm_as_of(r.customers, r.orders, r.order_lines, rfm.half_year_ends(r.orders, P.FIRST_CUTOFF))


@query
def price_current(w):
    return scd.price_current(w.retail.products, w.retail.price_history).drop("id_historico_precio")


@query
def price_validity(w):
    return scd.price_validity(w.retail.price_history)


def _scd2_product(w, strict):
    return scd.scd2_product(w.products, w.retail.price_history, strict, P.FIRST_DAY)


@query
def scd2_product(w):
    return _scd2_product(w, strict=False)


@query
def scd2_product_strict(w):
    return _scd2_product(w, strict=True)


def _scd2_customer(w, strict, build=scd.scd2_customer):
    r = w.retail
    rule = SNAPSHOT_RULE.with_amount(P.VIP_AMOUNT)
    return build(r.customers, r.cities, r.orders, r.order_lines, rfm.half_year_ends(r.orders, P.FIRST_CUTOFF), rule, strict)


@query
def scd2_customer(w):
    return _scd2_customer(w, strict=False)


@query
def scd2_customer_strict(w):
    return _scd2_customer(w, strict=True)


@query
def scd_audit(w):
    """Versions are counted, which needs no surrogate keys and so no sort of all of them."""
    products = scd.product_versions(w.products, w.retail.price_history, first_day=P.FIRST_DAY)
    customers = _scd2_customer(w, False, scd.customer_versions)
    return scd.scd_audit(products, "id_producto_nk", "producto").unionByName(scd.scd_audit(customers, "id_cliente_nk", "cliente"))


@query
def scd_example(w):
    return scd.first_changed_key(_scd2_customer(w, False), "id_cliente_nk").select(
        "id_cliente_sk", "id_cliente_nk", "segmento_rfm", "recency_dias", "frecuencia_compras", "monto_total",
        "fecha_inicio", "es_actual",
    )


@query
def dim_store_scd1(w):
    columns = ["id_tienda", "nombre_tienda", "nombre_ciudad", "region", "zona", "tipo", "tamano_m2"]
    return dimensions.with_audit_date(w.stores, columns, P.AUDIT_DAY)


@query
def dim_employee_scd1(w):
    employees = dimensions.employee_dim(w.retail.employees, w.retail.stores, "left")
    columns = ["id_empleado", "nombre_empleado", "cargo", "nombre_tienda", "fecha_contratacion", "salario"]
    return dimensions.with_audit_date(employees, columns, P.AUDIT_DAY)


@query
def dim_payment_scd1(w):
    return dimensions.with_audit_date(w.payments, ["id_metodo_pago", "nombre", "comision_pct"], P.AUDIT_DAY)


# --- cube -------------------------------------------------------------------------


def _cube_base(w, first="products"):
    r = w.retail
    return cube.cube_base(r.line_sources, r.orders, r.products, r.categories, r.line_amounts, first)


@query
def cube_n0(w):
    return cube.cube_level(_cube_base(w), 0)


@query
def cube_n1(w):
    return rounded(cube.cube_level(_cube_base(w, first="orders"), 1), "precio_promedio", decimals=8)


@query
def cube_n2(w):
    return cube.cube_level(_cube_base(w), 2)


@query
def cube_n3(w):
    return cube.cube_level(_cube_base(w), 3)


@query
def cube_n4(w):
    return cube.cube_level(_cube_base(w), 4)


@query
def cube_grouping_sets(w):
    base = stored(_cube_base(w).select(*cube.READ), "detalle_cubo")
    return cube.cube_grouping_sets(base, stored(cube.cube_state(base), "estado_cubo"))


@query
def cube_reconcile(w):
    base = stored(_cube_base(w).select(*cube.READ), "detalle_cubo")
    return cube.cube_reconcile(base, stored(cube.cube_state(base), "estado_cubo"))


# --- the warehouse as stored tables -----------------------------------------------

HISTORIES = {
    "Dim_Producto_SCD": scd2_product,
    "Dim_Cliente_SCD": scd2_customer,
    "Dim_Tienda_SCD": dim_store_scd1,
    "Dim_Empleado_SCD": dim_employee_scd1,
    "Dim_MetodoPago_SCD": dim_payment_scd1,
}


def warehouse_tables(w, root) -> dict[str, Callable[[], DataFrame]]:
    """Star, histories and cube levels, each built when it is called.

    The levels share one detail and state: level 0 as written below ``root``, if it was built before.
    """
    names = [f"Cubo_Ventas_N{n}" for n in range(5)]
    written = []

    def level_0():
        written.append(f"{root}/{names[0]}")
        return cube.cube_level(_cube_base(w), 0)

    @functools.cache
    def detail():
        if not written:
            return stored(_cube_base(w).select(*cube.READ), "detalle_cubo")
        # Stored, so that Spark knows how small the labels are.
        labels = stored(w.retail.categories.select("id_categoria", F.col("nombre").alias("categoria")), "categorias")
        return w.spark.read.parquet(written[0]).join(labels, "id_categoria", "left")

    state = functools.cache(lambda: stored(cube.cube_state(detail()), "estado_cubo"))
    histories = {name: functools.partial(build, w) for name, build in HISTORIES.items()}
    levels = {name: (lambda n=n: cube.cube_level(detail(), n, state() if n > 1 else None)) for n, name in enumerate(names)}
    return w.tables() | histories | levels | {names[0]: level_0}


@query
def load_warehouse(w):
    """Every table of the warehouse, stored, with its rows."""
    root = scratch_path(w.spark, "dw")
    return load_tables(w.spark, warehouse_tables(w, root), root)


@query
def warehouse_listing(w):
    """Columns and rows of some stored tables, chosen by name and by prefix."""
    root = scratch_path(w.spark, "dw")
    builds = audit.selected(warehouse_tables(w, root), P.LISTED, P.NOT_LISTED)
    load_tables(w.spark, builds, root)
    return audit.schema_listing(opened(w.spark, root, list(builds)))


@query
def load_metrics(w):
    """Rows, rows without a key, and amount of the tables of the star, as their writes measured them."""
    names = ["Dim_Tiempo", "Dim_Producto", "Dim_Tienda", "Dim_Empleado", "Dim_MetodoPago", "Fact_Ventas"]
    built = {name: w.tables()[name]() for name in names}
    return load_measured(w.spark, built, scratch_path(w.spark, "dw"))


@query
def catalog_listing(w):
    """Some dimensions saved as tables of a database of this run, as the catalog lists them."""
    database, root = f"vitrina_{uuid.uuid4().hex}", scratch_path(w.spark, "catalogo")
    built = {name: audit.commented(w.tables()[name](), P.COLUMN_NOTES) for name in P.CATALOG_TABLES}
    counts = save_all(w.spark, built, database, root)
    try:
        return audit.catalog_listing(w.spark, database, counts)
    finally:
        w.spark.sql(f"DROP DATABASE `{database}` CASCADE")


@query
def stored_star_join(w):
    """The star over lines and orders that are stored in buckets of the order key: their join moves neither."""
    database, root = f"vitrina_{uuid.uuid4().hex}", scratch_path(w.spark, "cubetas")
    w.spark.sql(f"CREATE DATABASE `{database}` LOCATION '{root}'")
    tables = {}
    for name, df in {"detalle": w.retail.order_lines, "ordenes": w.retail.orders}.items():
        table = f"`{database}`.`{name}`"
        overwrite(df, f"{root}/{name}", table=table, bucket_by=(P.ORDER_BUCKETS, "id_orden"))
        tables[name] = w.spark.table(table)
    fact = facts.sales_fact(tables["detalle"], tables["ordenes"].hint("merge"), w.calendar, facts.CALENDAR)
    out = facts.star(fact, products=w.products, stores=w.stores)
    return out.select(
        "id_detalle", "id_orden", "id_producto", "id_cliente", "id_tienda", "anio", "mes", "trimestre",
        "nombre_categoria", "margen_pct", "tipo_tienda", "ciudad_tienda", "zona_tienda", "cantidad", "subtotal",
    )


@query
def files_star_pivot(w):
    """The pivot over a warehouse whose source are the retail files, with amounts in whole numbers."""
    root = scratch_path(w.spark, "archivos")
    write_files(w.retail, root)
    return olap.pivot(Warehouse(RetailFiles(w.spark, root)).star("calendar", "products"))


@query
def files_return_rate(w):
    """Lines and returned lines per store of the order, from the retail files."""
    root = scratch_path(w.spark, "archivos")
    write_files(w.retail, root)
    source = RetailFiles(w.spark, root)
    sold = facts.order_detail(source.order_lines, source.orders).groupBy("id_tienda")
    return sold.agg(F.count(F.lit(1)).alias("lineas"), F.sum(F.col("devuelto").cast("long")).alias("devueltas"), F.sum("subtotal").alias("ventas"))


@query
def stored_star_pivot(w):
    """The pivot over a stored star: its scans repeat no join of lines and orders."""
    names = ["Fact_Ventas", "Dim_Tiempo", "Dim_Producto"]
    root = scratch_path(w.spark, "dw")
    load_tables(w.spark, {name: w.tables()[name] for name in names}, root)
    fact, calendar, products = opened(w.spark, root, names).values()
    return olap.pivot(facts.star(fact, calendar, products))


# --- OLAP -------------------------------------------------------------------------


@query
def olap_rollup(w):
    return olap.rollup(w.star("calendar"))


@query
def olap_monthly_series(w):
    return olap.monthly_series(olap.rollup(w.star("calendar")))


@query
def olap_slice(w):
    return olap.slice_(w.star("calendar", "products"), "nombre_categoria", P.SLICE_CATEGORY)


@query
def olap_dice(w):
    return olap.dice(w.star("calendar", "products", "stores"), P.DICE)


@query
def olap_drilldown(w):
    return olap.drilldown(w.star("calendar", "products"), "nombre_categoria", P.DRILL_CATEGORY)


@query
def olap_pivot(w):
    return olap.pivot(w.star("calendar", "products"))


@query
def distinct_years(w):
    return olap.distinct_sorted(w.star("calendar"), "anio")


# --- KPIs and dashboard -----------------------------------------------------------


@query
def kpi_totals(w):
    return kpi.totals(w.star("calendar", "products"))


@query
def kpi_yoy(w):
    return kpi.yoy(w.star("calendar"))


@query
def kpi_margin(w):
    return rounded(kpi.margin_by_category(w.star("products")), "margen_promedio")


@query
def kpi_summary(w):
    return kpi.summary_of_sums(stored(kpi.year_category_sums(w.star("calendar"), w.products), "ventas_anio_categoria"))


@query
def yoy_same_period(w):
    return rounded(kpi.yoy_same_period(w.star("calendar")), "crecimiento")


@query
def bi_measures(w):
    return rounded(kpi.bi_measures(w.fact, w.products), "margen_promedio")


@query
def dash_by_month(w):
    return olap.sales_by(w.star("calendar"), "anio", "mes")


@query
def dash_by_category(w):
    return olap.sales_by(w.star("products"), "nombre_categoria")


@query
def dash_by_city(w):
    return olap.sales_by(w.star("stores"), "ciudad_tienda")


@query
def dash_top_products(w):
    return olap.top_by_sales(w.star("products"), ["id_producto", "nombre_producto"])


# --- orders -----------------------------------------------------------------------


@query
def orders_in_status(w):
    return orders.orders_in_status(w.retail.orders, ["Completada", "Pendiente"])


@query
def orders_sorted(w):
    return w.retail.orders.select("id_orden", "fecha_orden").orderBy(F.desc("fecha_orden"), "id_orden")


@query
def lines_semi_orders(w):
    done = orders.orders_in_status(w.retail.orders, ["Completada"])
    lines = orders.lines_of(w.retail.order_lines, done)
    return lines.select("id_detalle", "id_orden", "id_producto", "cantidad", "subtotal")


@query
def promo_interval_join(w):
    return orders.active_promotions(w.retail.orders, w.retail.promotions)


@query
def promo_one_per_order(w):
    return orders.chosen_promotion(w.retail.orders, w.retail.promotions)


@query
def delivery_dates(w):
    return orders.delivery_dates(w.retail.shipments)


# --- mining: customers ------------------------------------------------------------


@query
def rfm_scaled(w):
    scaled = cluster.scaled_rfm(w.customers)
    z = [f"{c}_z" for c in cluster.RFM]
    return rounded(scaled.select("id_cliente", *z), *z)


@query
def kmeans_elbow(w):
    return cluster.elbow(w.customers, seed=P.SEED)


@query
def kmeans_segments(w):
    return cluster.segments(w.customers, k=4, seed=P.SEED)


@query
def cluster_profile(w):
    return cluster.profile(cluster.segments(w.customers, k=4, seed=P.SEED))


@query
def kmeans_best_k(w):
    return cluster.best_k(cluster.elbow(w.customers, seed=P.SEED))


def _scaled(w):
    """Scaled customers with their segment, stored because every measure reads them twice."""
    customers = stored(w.customers.select("id_cliente", "segmento_rfm", *cluster.RFM), "clientes")
    return stored(cluster.standardize(customers), "escalados"), [f"{c}_z" for c in cluster.RFM]


@query
def segment_inertia(w):
    """Squared distances to the centre of each segment, the segment taken as a cluster."""
    points, columns = _scaled(w)
    return rounded(cluster.inertia(points, "segmento_rfm", columns), "inercia", decimals=4)


@query
def segment_silhouette(w):
    points, columns = _scaled(w)
    measured = cluster.silhouette(points, "segmento_rfm", columns)
    means = measured.groupBy("segmento_rfm").agg(F.count(F.lit(1)).alias("clientes"), F.avg("silueta").alias("silueta"))
    return rounded(means, "silueta")


@query
def segment_profile(w):
    return cluster.profile(w.customers.withColumn("cluster", F.col("segmento_rfm")))


def _band_elbow(w):
    points, columns = _scaled(w)
    banded = [cluster.quality(cluster.amount_bands(points, "monto_total", k), "cluster", columns).withColumn("k", F.lit(k)) for k in P.BANDS]
    return audit.union_all(banded)


@query
def band_elbow(w):
    """Inertia and silhouette of 2 to 6 bands of the amount: an elbow without a model."""
    return rounded(rounded(_band_elbow(w), "inercia", decimals=4), "silueta")


@query
def band_best_k(w):
    return rounded(cluster.best_k(_band_elbow(w)), "silueta")


@query
def churn_label(w):
    return churn.churn_label(w.customers).select("id_cliente", "recency", "churn")


@query
def churn_rate(w):
    return rounded(churn.churn_rate(churn.churn_label(w.customers)), "tasa")


def _churn_features(w):
    return churn.churn_features(w.retail.customers, w.retail.orders, w.retail.order_lines)


@query
def churn_features(w):
    return rounded(_churn_features(w), "tasa_devolucion")


@query
def train_test_split(w):
    return churn.with_split(w.customers.select("id_cliente"), "id_cliente", seed=P.SEED)


@query
def class_weights(w):
    """Balanced weight of each class of the training part."""
    train = churn.with_split(churn.churn_label(w.customers), "id_cliente", seed=P.SEED).where("es_entrenamiento")
    weighted = churn.with_balanced_weight(train, "churn")
    sizes = weighted.groupBy("churn").agg(F.count(F.lit(1)).alias("filas"), F.first("peso").alias("peso"))
    return rounded(sizes, "peso")


@query
def stratified_folds(w):
    """The fold of every customer; the rows of a class are dealt in turn."""
    labelled = churn.churn_label(w.customers).select("id_cliente", "churn")
    return churn.with_fold(labelled, "id_cliente", "churn", P.FOLDS, P.SEED)


@query
def churn_forest(w):
    frame = churn.training_frame(_churn_features(w), seed=P.SEED)
    return churn.test_predictions(churn.fit_on_train(churn.forest(seed=P.SEED), frame), frame)


@query
def churn_report(w):
    """Precision, recall and F1 of the forest on the test part."""
    frame = churn.training_frame(_churn_features(w), seed=P.SEED)
    scored = churn.test_predictions(churn.fit_on_train(churn.forest(seed=P.SEED), frame), frame)
    return metrics.classification_metrics(scored, "churn", "prediccion")


@query
def churn_importance(w):
    frame = churn.training_frame(_churn_features(w), seed=P.SEED)
    model = churn.fit_on_train(churn.forest(seed=P.SEED), frame)
    return churn.importance(model, churn.feature_list(), frame)


@query
def churn_tree(w):
    frame = churn.training_frame(_churn_features(w), seed=P.SEED)
    return churn.tree_rules(churn.fit_on_train(churn.tree(seed=P.SEED), frame), churn.feature_list(), frame)


@query
def churn_cv(w):
    frame = churn.training_frame(_churn_features(w), seed=P.SEED)
    return churn.cross_validate(churn.forest(seed=P.SEED), frame, "churn", "id_cliente", seed=P.SEED)


def _walked(w, frame=None):
    """Customers on their way through the fixed tree."""
    nodes = trees.tree_table(w.spark, P.TREE)
    return trees.paths(_churn_features(w) if frame is None else frame, nodes, churn.FEATURES, P.TREE_DEPTH), nodes


@query
def tree_predictions(w):
    walked, _ = _walked(w)
    return walked.select("id_cliente", "churn", "prediccion", F.element_at("camino", -1).alias("hoja"))


@query
def tree_nodes(w):
    """The fixed tree with the customers and the impurity of every node."""
    counts = trees.node_counts(*_walked(w), "churn")
    positive = F.col("peso_positivo").cast("long").alias("positivos")
    return rounded(counts.select("nodo", "padre", "lado", "feature", "limite", "filas", positive, "gini"), "gini")


@query
def tree_importance(w):
    counts = stored(trees.node_counts(*_walked(w), "churn"), "nodos")
    return rounded(trees.importance(counts, churn.FEATURES), "importancia")


@query
def tree_fold_accuracy(w):
    """Accuracy of the fixed tree on each fold of the customers."""
    folded = churn.with_fold(_churn_features(w), "id_cliente", "churn", P.FOLDS, P.SEED)
    walked, _ = _walked(w, folded)
    right = F.avg((F.col("churn") == F.col("prediccion")).cast("double")).alias("exactitud")
    return rounded(walked.groupBy("fold").agg(F.count(F.lit(1)).alias("filas"), right), "exactitud")


def _fixed_rule(w):
    """Churn against a plain rule on the number of orders, to check the metrics exactly."""
    guess = (F.col("frecuencia") < P.ORDERS_RULE).cast("int")
    return churn.churn_label(w.customers).select("churn", guess.alias("prediccion"))


@query
def confusion_matrix(w):
    return metrics.confusion_matrix(_fixed_rule(w), "churn", "prediccion")


@query
def classification_metrics(w):
    report = metrics.classification_metrics(_fixed_rule(w), "churn", "prediccion")
    return rounded(report, "precision", "recall", "f1")


# --- mining: products -------------------------------------------------------------


def _profile(w):
    names = w.products.select("id_producto", "nombre_producto", "nombre_categoria")
    return returns.product_profile(w.retail.order_lines.join(names, "id_producto"))


@query
def product_profile(w):
    return rounded(_profile(w), "precio_promedio")


@query
def price_band(w):
    banded = returns.price_band(_profile(w), P.PRICE_EDGES, P.PRICE_LABELS)
    return rounded(banded.select("id_producto", "precio_promedio", "rango_precio"), "precio_promedio")


def _scored(w):
    return returns.risk_score(_profile(w), P.HIGH_PRICE, P.RISKY_CATEGORIES)


@query
def return_risk_score(w):
    return _scored(w).select("id_producto", "nombre_categoria", "prob_devolucion")


@query
def return_label(w):
    return returns.return_label(_profile(w)).select("id_producto", "lineas", "lineas_devueltas", "devuelto")


@query
def return_rate_category(w):
    return returns.return_rate_by_category(returns.return_label(_profile(w)))


@query
def label_encode(w):
    return returns.label_encode(w.products.select("id_producto", "nombre_categoria"), "nombre_categoria", "categoria_cod")


def _bayes_frame(w):
    risky = (F.col("prob_devolucion") >= P.RISK_THRESHOLD).cast("int")
    coded = returns.label_encode(_scored(w), "nombre_categoria", "categoria_cod")
    return coded.select("id_producto", *P.BAYES_FEATURES, risky.alias("riesgo"))


@query
def naive_bayes_fit(w):
    model = returns.class_moments(_bayes_frame(w), P.BAYES_FEATURES, "riesgo")
    return rounded(model, "prior", "media", "varianza", decimals=4)


@query
def naive_bayes_predict(w):
    frame = stored(_bayes_frame(w))
    model = returns.fit_bayes(frame, P.BAYES_FEATURES, "riesgo")
    scored = returns.predict_bayes(frame, model, P.BAYES_FEATURES)
    return rounded(scored.select("id_producto", "riesgo", "prediccion", "probabilidad"), "probabilidad")


@query
def naive_bayes_accuracy(w):
    """Fit on the training part, accuracy on the rest."""
    frame = stored(churn.with_split(_bayes_frame(w), "id_producto", seed=P.SEED))
    model = returns.fit_bayes(frame.where("es_entrenamiento"), P.BAYES_FEATURES, "riesgo")
    test = frame.where(~F.col("es_entrenamiento"))
    return rounded(returns.accuracy(returns.predict_bayes(test, model, P.BAYES_FEATURES), "riesgo"), "exactitud")


@query
def naive_bayes_cv(w):
    frame = stored(churn.with_fold(_bayes_frame(w), "id_producto", "riesgo", P.FOLDS, P.SEED))
    result = returns.cross_validate_bayes(frame, P.BAYES_FEATURES, "riesgo", "fold", P.FOLDS)
    return rounded(result, "exactitud_media")


# --- mining: series and correlation -----------------------------------------------


@query
def weekly_sales(w):
    return seasonality.weekly_sales(w.fact)


@query
def seasonal_decompose(w):
    parts = seasonality.seasonal_decompose(seasonality.weekly_sales(w.fact))
    return rounded(parts, "tendencia", "estacional", "residuo", decimals=1)


@query
def seasonal_by_category(w):
    weekly = seasonality.weekly_sales(w.star("products"), ["nombre_categoria"])
    parts = seasonality.seasonal_decompose(weekly, ["nombre_categoria"])
    return rounded(parts, "tendencia", "estacional", "residuo", decimals=1)


@query
def monthly_category_matrix(w):
    matrix = correlation.monthly_matrix(w.star("calendar", "products"), P.CATEGORIES)
    return rounded(matrix, correlation.TOTAL, decimals=4)


def _correlations(w):
    sold = stored(correlation.monthly_sales(w.star("calendar", "products")), "ventas_mensuales")
    return correlation.correlation_matrix(correlation.monthly_cells(sold, w.retail.categories))


@query
def category_correlation(w):
    return rounded(_correlations(w), "correlacion")


@query
def top_correlations(w):
    return rounded(correlation.top_correlations(_correlations(w)), "correlacion")


# --- mining: baskets --------------------------------------------------------------


@query
def basket_items(w):
    return basket.basket_items(w.retail.order_lines)


@query
def basket_sample(w):
    with_lines = w.retail.order_lines.select("id_orden").distinct()
    return basket.basket_sample(with_lines, P.SAMPLE, P.SEED)


def _sold(w, item):
    return w.retail.order_lines.join(w.retail.brands, "id_producto").select("id_orden", item).na.drop()


@query
def baskets(w):
    arrays = basket.baskets(basket.basket_items(_sold(w, "marca"), item="marca"), item="marca")
    return arrays.select("id_orden", F.size("items").alias("num_items"), basket.label("items").alias("items"))


def _itemsets(w, item, support):
    return basket.frequent_itemsets(_sold(w, item), support, item=item)


def _shown_sets(sets):
    shown = sets.select(basket.label("items").alias("items"), F.size("items").alias("num_items"), "frecuencia", "soporte")
    return rounded(shown, "soporte")


@query
def frequent_itemsets(w):
    return _shown_sets(_itemsets(w, "marca", P.BRAND_SUPPORT))


@query
def frequent_itemsets_category(w):
    return _shown_sets(_itemsets(w, "categoria", P.TYPE_SUPPORT))


@query
def top_itemsets(w):
    return rounded(basket.top_itemsets(_itemsets(w, "marca", P.BRAND_SUPPORT)), "soporte")


@query
def itemset_chart_labels(w):
    """The most frequent sets of types under a label of their first items, as a chart shows them."""
    return rounded(basket.top_itemsets(_itemsets(w, "categoria", P.TYPE_SUPPORT), n=P.CHART_SETS, first=P.CHART_ITEMS), "soporte")


def _shown_rules(rules):
    shown = rules.withColumns({c: basket.label(c) for c in ("antecedente", "consecuente")})
    return rounded(shown, "soporte_a", "soporte_c", "soporte", "confianza", "lift", "leverage", "conviccion")


@query
def association_rules(w):
    return _shown_rules(basket.association_rules(_itemsets(w, "categoria", P.TYPE_SUPPORT)))


@query
def association_rules_brand(w):
    return _shown_rules(basket.association_rules(_itemsets(w, "marca", P.BRAND_SUPPORT)))


@query
def top_rules(w):
    rules = basket.association_rules(_itemsets(w, "categoria", P.TYPE_SUPPORT))
    return rounded(basket.top_rules(rules), "soporte", "confianza", "lift")
