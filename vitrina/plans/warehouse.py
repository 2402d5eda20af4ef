"""The star schema as a set of tables: build, load, open, export."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from vitrina.functions.rules import DIMENSION_RULE, SegmentRule
from vitrina.operators import dimensions as dims
from vitrina.operators.facts import CALENDAR, sales_fact, star
from vitrina.sinks.writers import export_csv, load_tables
from vitrina.sources.retail import Retail

STAR_TABLES = [
    "Dim_Tiempo", "Dim_Producto", "Dim_Cliente", "Dim_Tienda", "Dim_Empleado", "Dim_MetodoPago", "Dim_Proveedor",
    "Dim_Campana", "Fact_Ventas",
]


class Warehouse:
    """Lazy star schema over the operational tables.

    Each property is a plan, not data: a query over the fact and one dimension
    never touches the others.  ``load`` stores the tables; ``opened`` reads them.
    """

    def __init__(self, retail: Retail, campaigns: Callable[[], DataFrame] | None = None, rule: SegmentRule = DIMENSION_RULE):
        self.retail = retail
        self.spark = retail.spark
        self.rule = rule
        self._campaigns = campaigns

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.calendar_dim(self.retail.orders, "fecha_orden")

    @cached_property
    def products(self) -> DataFrame:
        r = self.retail
        return dims.product_dim(r.products, r.categories, r.suppliers)

    @cached_property
    def customers(self) -> DataFrame:
        r = self.retail
        return dims.customer_dim(r.customers, r.cities, r.orders, r.order_lines, self.rule)

    @cached_property
    def stores(self) -> DataFrame:
        return dims.store_dim(self.retail.stores, self.retail.cities)

    @cached_property
    def employees(self) -> DataFrame:
        return dims.employee_dim(self.retail.employees, self.retail.stores)

    @cached_property
    def payments(self) -> DataFrame:
        return dims.payment_dim(self.retail.payment_methods)

    @cached_property
    def suppliers(self) -> DataFrame:
        return dims.supplier_dim(self.retail.suppliers, self.retail.external_suppliers)

    @cached_property
    def campaigns(self) -> DataFrame:
        if self._campaigns is None:
            raise ValueError("this warehouse has no campaign source")
        return dims.campaign_dim(self._campaigns())

    @cached_property
    def fact(self) -> DataFrame:
        return self._fact()

    def _fact(self, attributes: Sequence[str] = ()) -> DataFrame:
        r = self.retail
        return sales_fact(r.line_sources, r.orders, self.calendar, attributes, r.line_amounts)

    def star(self, *names: str) -> DataFrame:
        """Fact joined with the named dimensions (calendar, products, customers, stores)."""
        fact, others = self.fact, [name for name in names if name != "calendar"]
        if "calendar" in names:
            # The date lookup of the fact already meets the calendar once.
            fact = self._fact(CALENDAR)
        return star(fact, **{name: getattr(self, name) for name in others})

    def tables(self) -> dict[str, Callable[[], DataFrame]]:
        sources = ["calendar", "products", "customers", "stores", "employees", "payments", "suppliers", "campaigns", "fact"]
        named = dict(zip(STAR_TABLES, sources, strict=True))
        if self._campaigns is None:
            del named["Dim_Campana"]
        return {table: (lambda source=source: getattr(self, source)) for table, source in named.items()}

    def load(self, root: str) -> DataFrame:
        """Write the whole star and return the manifest."""
        return load_tables(self.spark, {name: build() for name, build in self.tables().items()}, root)

    def export(self, root: str, stored: str | None = None) -> DataFrame:
        """Export the whole star as CSV and return the log.

        The tables come from those stored below ``stored``, or else from their plans, which then
        leave no second copy of the star beside the files.
        """
        tables = self.tables()
        if stored is not None:
            tables = {name: (lambda name=name: self.spark.read.parquet(f"{stored}/{name}")) for name in tables}
        return export_csv(self.spark, tables, root)


def opened(spark: SparkSession, root: str, tables: list[str] = STAR_TABLES) -> dict[str, DataFrame]:
    """The stored star: queries over it scan the fact without repeating its join."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in tables}
