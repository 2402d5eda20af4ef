"""Values the registered queries and their SQL share."""

from __future__ import annotations

from datetime import date

SLICE_CATEGORY = "LARGE"
DRILL_CATEGORY = "PROMO"
DICE = {"nombre_categoria": "LARGE", "ciudad_tienda": "NATION_3", "anio": 1997}

VIP_AMOUNT = 1_500_000
# First snapshot; the others are the half-year ends after it, up to the one that sees every order.
FIRST_CUTOFF = date(1995, 1, 31)
FIRST_DAY = date(1995, 1, 1)
AUDIT_DAY = date(2001, 12, 31)

PRICE_EDGES = [0, 1800, 2100, 2400, 1_000_000]
PRICE_LABELS = ["Bajo", "Medio", "Alto", "Premium"]
HIGH_PRICE = 2100
RISKY_CATEGORIES = ["LARGE", "PROMO"]
RISK_THRESHOLD = 0.20
BAYES_FEATURES = ["precio_promedio", "cantidad", "categoria_cod"]

BRAND_SUPPORT = 0.02
TYPE_SUPPORT = 0.03
SEED = 42
SAMPLE = 500
FOLDS = 5

ORDERS_RULE = 10  # orders below which the fixed churn rule predicts churn

# Tables of the listing: these names, less those with one of the prefixes.
LISTED = ["Dim_Tienda_SCD", "Dim_Empleado_SCD", "Dim_MetodoPago_SCD", "Cubo_Ventas_N1", "Cubo_Ventas_N4"]
NOT_LISTED = ["Cubo_"]

# Columns of the wide monthly matrix.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

BANDS = range(2, 7)  # numbers of amount bands whose quality is compared
CHART_SETS, CHART_ITEMS = 15, 2

# A tree written by hand: node, parent, side, feature, limit, prediction.
TREE = [
    (0, None, None, "frecuencia", 10.0, 0),
    (1, 0, "<=", "monto_total", 1_000_000.0, 1),
    (2, 0, ">", "dias_desde_registro", 2400.0, 0),
    (3, 1, "<=", None, None, 1),
    (4, 1, ">", "tasa_devolucion", 0.25, 0),
    (5, 2, "<=", None, None, 1),
    (6, 2, ">", None, None, 0),
    (7, 4, "<=", None, None, 0),
    (8, 4, ">", None, None, 1),
]
TREE_DEPTH = 3

# Tables of the catalog listing and the comments of their columns.
CATALOG_TABLES = ["Dim_Tiempo", "Dim_Tienda", "Dim_MetodoPago"]
COLUMN_NOTES = {
    "id_tiempo": "clave del día",
    "id_tienda": "clave de la tienda",
    "id_metodo_pago": "clave del método de pago",
    "comision_pct": "comisión en por ciento",
    "es_fin_semana": "sábado o domingo",
}
ORDER_BUCKETS = 8
