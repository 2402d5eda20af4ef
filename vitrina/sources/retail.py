"""The operational retail tables, derived from the driver's order tables.

Every method returns a lazy DataFrame over whole tables; Catalyst prunes what a
query does not use.  ``plans/oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.dates import plus_hours
from vitrina.functions.measures import hundredths
from vitrina.operators.keys import dense_rank_of_values
from vitrina.sources.readers import read_table
from vitrina.sources.schemas import TABLES

ZONES = ["Centro", "Norte", "Occidente", "Oriente"]

# Source columns of the amounts of a line, and the columns of a line.
LINE_SOURCES = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]
LINE = [
    "id_detalle", "id_orden", "id_producto", "id_tienda", "cantidad", "precio_unitario", "descuento", "subtotal", "devuelto",
]

# First day of the promotion windows.
PROMOTIONS_FROM = date(1995, 1, 1)


class Retail:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.path}/{name}.parquet", TABLES[name])

    def _rows(self, name: str) -> Column:
        return self.raw(name).agg(F.count(F.lit(1))).scalar()

    @cached_property
    def cities(self) -> DataFrame:
        zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("r_regionkey") % len(ZONES) + 1).cast("int"))
        return (
            self.raw("nation")
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").cast("long").alias("id_ciudad"),
                F.col("n_name").alias("nombre"),
                F.col("r_name").alias("region"),
                zone.alias("zona"),
            )
        )

    @cached_property
    def categories(self) -> DataFrame:
        return dense_rank_of_values(self.raw("part"), "p_type", "id_categoria", start=1).withColumnRenamed(
            "p_type", "nombre"
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        return (
            self.raw("supplier")
            .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("id_proveedor"),
                F.col("s_name").alias("nombre"),
                F.col("n_name").alias("pais"),
            )
        )

    @cached_property
    def external_suppliers(self) -> DataFrame:
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("id_proveedor_ext"),
                F.col("c_name").alias("nombre_empresa"),
                F.col("n_name").alias("pais"),
            )
        )

    def _cost(self, cents: Column, key: Column) -> Column:
        """35 % to 75 % of the price, computed in whole cents."""
        return F.floor((cents * (key % 9 * 5 + 35) + 50) / 100).cast("double") / 100

    @cached_property
    def products(self) -> DataFrame:
        categories = self.categories.withColumnRenamed("nombre", "p_type")
        return (
            self.raw("part")
            .join(categories, "p_type")
            .select(
                F.col("p_partkey").alias("id_producto"),
                F.concat_ws("-", "p_name", F.col("p_partkey").cast("string")).alias("nombre"),
                "id_categoria",
                (F.col("p_partkey") % self._rows("supplier")).alias("id_proveedor"),
                F.col("p_retailprice").alias("precio_unitario"),
                self._cost(hundredths("p_retailprice"), F.col("p_partkey")).alias("costo_unitario"),
                (F.col("p_size") % 12 != 0).alias("activo"),
            )
        )

    @cached_property
    def brands(self) -> DataFrame:
        """Product with its brand and type, the item vocabularies of the baskets."""
        return self.raw("part").select(
            F.col("p_partkey").alias("id_producto"), F.col("p_brand").alias("marca"), F.col("p_type").alias("categoria")
        )

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("id_cliente"),
            F.col("c_name").alias("nombre"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
            F.col("c_nationkey").cast("long").alias("id_ciudad"),
            F.date_add(F.lit(date(1993, 1, 1)), (key % 700).cast("int")).alias("fecha_registro"),
            F.col("c_mktsegment").alias("segmento"),
            (key % 60 + 18).cast("int").alias("edad"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("genero"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("id_tienda"),
            F.col("s_name").alias("nombre"),
            F.col("s_nationkey").cast("long").alias("id_ciudad"),
            F.when(key % 5 == 0, "Virtual").otherwise("Física").alias("tipo"),
            (key % 750 + 50).alias("tamano_m2"),
        )

    @cached_property
    def employees(self) -> DataFrame:
        """One per customer row; the last residue class has no store, so inner and left joins differ."""
        return self.raw("customer").select(
            F.col("c_custkey").alias("id_empleado"),
            F.col("c_name").alias("nombre"),
            F.col("c_mktsegment").alias("cargo"),
            (F.col("c_custkey") % (self._rows("supplier") + 1)).alias("id_tienda"),
            F.date_add(F.lit(date(1990, 1, 1)), (F.col("c_custkey") % 1500).cast("int")).alias("fecha_contratacion"),
            F.col("c_acctbal").alias("salario"),
        )

    @cached_property
    def payment_methods(self) -> DataFrame:
        key = F.substring("o_orderpriority", 1, 1).cast("long")
        return (
            self.raw("orders")
            .select("o_orderpriority")
            .distinct()
            .select(
                key.alias("id_metodo_pago"),
                F.substr("o_orderpriority", F.lit(3)).alias("nombre"),
                ((key * 6 + 5).cast("double") / 10).alias("comision_pct"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("id_orden"),
            F.col("o_custkey").alias("id_cliente"),
            (key % self._rows("customer")).alias("id_empleado"),
            F.substring("o_orderpriority", 1, 1).cast("long").alias("id_metodo_pago"),
            plus_hours("o_orderdate", key % 24).alias("fecha_orden"),
            F.when(F.col("o_orderstatus") == "F", "Completada")
            .when(F.col("o_orderstatus") == "O", "Pendiente")
            .otherwise("Cancelada")
            .alias("estado"),
        )

    @cached_property
    def line_sources(self) -> DataFrame:
        """Lines with their keys and the source columns of their amounts, for joins that move them."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("id_orden"),
            F.col("l_partkey").alias("id_producto"),
            F.col("l_suppkey").alias("id_tienda"),
            *LINE_SOURCES,
        )

    @staticmethod
    def line_amounts(lines: DataFrame) -> DataFrame:
        """``line_sources``, joined or not, with the columns of ``order_lines`` in place of their sources.

        ``subtotal``, price by (1 - discount), is computed in whole ten-thousandths: it carries no rounding noise.
        """
        net = hundredths("l_extendedprice") * (100 - hundredths("l_discount"))
        amounts = {
            "id_detalle": F.col("id_orden") * 10 + F.col("l_linenumber"),
            "cantidad": F.col("l_quantity").cast("long"),
            "precio_unitario": F.col("l_extendedprice") / F.col("l_quantity"),
            "descuento": F.col("l_discount"),
            "subtotal": net.cast("double") / 10_000,
            "devuelto": F.col("l_returnflag") == "R",
        }
        return lines.withColumns(amounts).drop(*LINE_SOURCES)

    @cached_property
    def order_lines(self) -> DataFrame:
        return self.line_amounts(self.line_sources).select(*LINE)

    @cached_property
    def price_history(self) -> DataFrame:
        """One price per product and quarter of shipment; open end on the latest one."""
        unit = F.col("l_extendedprice") / F.col("l_quantity")
        quarters = F.year("l_shipdate") * 4 + F.quarter("l_shipdate") - 1
        per_quarter = (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("id_producto"), quarters.alias("q"))
            .agg(F.max(F.floor(unit * 100)).alias("centavos"))
        )
        price = (F.col("centavos").cast("double") / 100).alias("precio")
        start = F.make_date((F.col("q") / 4).cast("int"), F.pmod("q", F.lit(4)) * 3 + 1, F.lit(1))
        return per_quarter.select(
            (F.col("id_producto") * 100000 + F.col("q")).alias("id_historico_precio"),
            "id_producto",
            price,
            self._cost(F.col("centavos"), F.col("id_producto")).alias("costo"),
            start.alias("fecha_inicio"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        """One per supplier, for up to three weeks; some have no end, some end in the far future."""
        key = F.col("s_suppkey")
        late = F.pmod(key, F.lit(100)).isin(7, 9)
        day = F.when(late, 2000 + key % 300).otherwise(key * 37 % 2400)
        start = F.date_add(F.lit(PROMOTIONS_FROM), day.cast("int"))
        end = (
            F.when(F.pmod(key, F.lit(100)) == 9, F.lit(date(9999, 12, 31)))
            .when(~late, F.date_add(start, (key % 21).cast("int")))
        )
        return self.raw("supplier").select(
            key.alias("id_promocion"),
            F.concat(F.lit("Oferta "), "s_name").alias("nombre"),
            F.when(key % 3 == 0, "Fijo").otherwise("Porcentaje").alias("tipo"),
            (key % 17 + 3).cast("long").alias("valor"),
            start.alias("fecha_inicio"),
            end.alias("fecha_fin"),
            (key % 4 != 0).alias("activa"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        """Order with its promised lead time and the delay of the delivery, both in days."""
        return self.orders.select(
            "id_orden",
            "fecha_orden",
            (F.col("id_orden") % 9 + 1).alias("tiempo_entrega_dias"),
            (F.col("id_orden") % 7 - 2).alias("retraso_dias"),
        )
