"""Declared schemas (DDL text): nothing is inferred from files."""

from __future__ import annotations

# Driver tables (parquet).
TABLES: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}

# Retail source files (CSV, header row).
FILES: dict[str, str] = {
    "categorias": "id_categoria BIGINT, nombre STRING, descripcion STRING",
    "proveedores": "id_proveedor BIGINT, nombre STRING, pais STRING, tiempo_entrega_dias BIGINT, calificacion DOUBLE",
    "ciudades": "id_ciudad BIGINT, nombre STRING, region STRING, zona STRING",
    "tiendas": "id_tienda BIGINT, nombre STRING, id_ciudad BIGINT, tipo STRING, tamano_m2 BIGINT",
    "metodospago": "id_metodo_pago BIGINT, nombre STRING, comision_pct DOUBLE",
    "productos": "id_producto BIGINT, nombre STRING, id_categoria BIGINT, id_proveedor BIGINT, "
    "precio_unitario DOUBLE, costo_unitario DOUBLE, stock_minimo BIGINT, activo BOOLEAN",
    "empleados": "id_empleado BIGINT, nombre STRING, cargo STRING, id_tienda BIGINT, "
    "fecha_contratacion DATE, salario DOUBLE",
    "historicoprecios": "id_historico_precio BIGINT, id_producto BIGINT, precio BIGINT, costo BIGINT, "
    "fecha_inicio DATE, fecha_fin DATE, motivo_cambio STRING",
    "promociones": "id_promocion BIGINT, nombre STRING, tipo STRING, valor BIGINT, fecha_inicio DATE, "
    "fecha_fin DATE, categoria_aplica STRING, activa BOOLEAN",
    "promocionesorden": "id_promocion_orden BIGINT, id_orden BIGINT, id_promocion BIGINT, descuento_aplicado DOUBLE",
    "inventario": "id_inventario BIGINT, id_producto BIGINT, id_tienda BIGINT, cantidad_disponible BIGINT, "
    "cantidad_reservada BIGINT, ultima_actualizacion DATE",
    "encuestas": "id_encuesta BIGINT, id_cliente BIGINT, fecha_encuesta DATE, satisfaccion BIGINT, "
    "recomendaria STRING, comentarios STRING",
    "mercado_categorias": "id_categoria BIGINT, tamano_mercado_millones BIGINT, crecimiento_anual_pct DOUBLE, "
    "indice_competitividad DOUBLE, tendencia STRING",
    "clientes": "id_cliente BIGINT, nombre STRING, email STRING, id_ciudad BIGINT, fecha_registro DATE, "
    "segmento STRING, edad INT, genero STRING",
    "ordenes": "id_orden BIGINT, id_cliente BIGINT, id_empleado BIGINT, id_tienda BIGINT, id_metodo_pago BIGINT, "
    "fecha_orden TIMESTAMP_NTZ, estado STRING",
    "detalleordenes": "id_detalle BIGINT, id_orden BIGINT, id_producto BIGINT, cantidad BIGINT, "
    "precio_unitario DOUBLE, descuento DOUBLE, subtotal BIGINT",
    "devoluciones": "id_devolucion BIGINT, id_orden BIGINT, id_producto BIGINT, cantidad BIGINT, motivo STRING, "
    "fecha_devolucion TIMESTAMP_NTZ, reembolso_pct BIGINT",
    "envios": "id_envio BIGINT, id_orden BIGINT, empresa_envio STRING, costo_envio DOUBLE, "
    "tiempo_entrega_dias BIGINT, fecha_estimada TIMESTAMP_NTZ, fecha_real TIMESTAMP_NTZ",
    "proveedores_externos": "id_proveedor_ext BIGINT, nombre_empresa STRING, especialidad STRING, "
    "costo_mensual DOUBLE, calificacion_promedio DOUBLE, pais STRING",
}

# One XML element per campaign; the attribute ``id`` is read as ``_id``.
CAMPAIGN_TAG = "campana"
CAMPAIGN = (
    "_id STRING, nombre STRING, tipo STRING, inicio DATE, fin DATE, presupuesto DOUBLE, "
    "categorias STRING, incremento_ventas_pct DOUBLE"
)
