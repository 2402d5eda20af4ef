"""The operational retail tables from their own CSV files, one per table, with declared schemas.

A drop-in for ``Retail``: the same attributes, so a ``Warehouse`` over a folder of files is
``Warehouse(RetailFiles(spark, folder))``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.measures import line_subtotal
from vitrina.sources.readers import read_csv
from vitrina.sources.retail import Retail
from vitrina.sources.schemas import FILES


class RetailFiles:
    """Lazy tables over ``<folder>/<table>.csv``; each is a file or a folder of files with a header."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_csv(self.spark, f"{self.path}/{name}.csv", FILES[name])

    @cached_property
    def cities(self) -> DataFrame:
        return self.table("ciudades")

    @cached_property
    def categories(self) -> DataFrame:
        return self.table("categorias").select("id_categoria", "nombre")

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.table("proveedores").select("id_proveedor", "nombre", "pais")

    @cached_property
    def external_suppliers(self) -> DataFrame:
        return self.table("proveedores_externos").select("id_proveedor_ext", "nombre_empresa", "pais")

    @cached_property
    def products(self) -> DataFrame:
        return self.table("productos").drop("stock_minimo")

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("clientes")

    @cached_property
    def stores(self) -> DataFrame:
        return self.table("tiendas")

    @cached_property
    def employees(self) -> DataFrame:
        return self.table("empleados")

    @cached_property
    def payment_methods(self) -> DataFrame:
        return self.table("metodospago")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("ordenes")

    @cached_property
    def order_lines(self) -> DataFrame:
        """Lines with their whole amounts; a line is returned if its product came back from its order."""
        returned = self.table("devoluciones").select("id_orden", "id_producto").distinct().withColumn("_devuelto", F.lit(True))
        lines = self.table("detalleordenes").join(returned, ["id_orden", "id_producto"], "left")
        return lines.select(*FILE_LINE, F.coalesce("_devuelto", F.lit(False)).alias("devuelto"))

    @property
    def line_sources(self) -> DataFrame:
        """The lines themselves: their files hold the amounts."""
        return self.order_lines

    @staticmethod
    def line_amounts(lines: DataFrame) -> DataFrame:
        return lines

    @cached_property
    def price_history(self) -> DataFrame:
        return self.table("historicoprecios").drop("motivo_cambio")

    @cached_property
    def promotions(self) -> DataFrame:
        return self.table("promociones").drop("categoria_aplica")

    @cached_property
    def shipments(self) -> DataFrame:
        """Promised lead time and delay of each delivery, in days."""
        late = F.date_diff(F.to_date("fecha_real"), F.to_date("fecha_estimada")).cast("long")
        sent = self.table("envios").select("id_orden", "tiempo_entrega_dias", late.alias("retraso_dias"))
        return self.orders.select("id_orden", "fecha_orden").join(sent, "id_orden")


FILE_LINE = ["id_detalle", "id_orden", "id_producto", "cantidad", "precio_unitario", "descuento", "subtotal"]


def file_tables(retail: Retail) -> dict[str, DataFrame]:
    """The tables of the star in the layout of their files: the store on the order, amounts as whole numbers.

    An order's store is the smallest of its lines.
    """
    store = retail.order_lines.groupBy("id_orden").agg(F.min("id_tienda").alias("id_tienda"))
    amount = line_subtotal("precio_unitario", "cantidad", "descuento").cast("long")
    found = {
        "categorias": retail.categories,
        "proveedores": retail.suppliers,
        "ciudades": retail.cities,
        "tiendas": retail.stores,
        "metodospago": retail.payment_methods,
        "productos": retail.products,
        "empleados": retail.employees,
        "clientes": retail.customers,
        "ordenes": retail.orders.join(store, "id_orden", "left"),
        "detalleordenes": retail.order_lines.withColumn("subtotal", amount),
        "devoluciones": retail.order_lines.where("devuelto").select(
            F.col("id_detalle").alias("id_devolucion"), "id_orden", "id_producto", "cantidad"
        ),
    }
    return {name: _laid_out(df, FILES[name]) for name, df in found.items()}


def _laid_out(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a file in order; those that the frame lacks are empty."""
    fields = [field.split() for field in schema.split(", ")]
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields])


def write_files(retail: Retail, root: str) -> None:
    for name, df in file_tables(retail).items():
        df.write.option("header", True).option("escape", '"').csv(f"{root}/{name}.csv")
