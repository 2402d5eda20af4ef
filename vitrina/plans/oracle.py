"""SQL for the registered queries, over the same tables.

``VIEWS`` states the operational tables and the shared intermediate results;
``SQL`` the queries.  ``oracle_sql`` puts the views a query needs in front of it.
"""

from __future__ import annotations

import re

from vitrina.plans import parameters as P
_risky = ", ".join(f"'{c}'" for c in P.RISKY_CATEGORIES)


def _cost(price: str, key: str) -> str:
    return (
        f"CAST(CAST(CAST({price} AS DECIMAL(12,2)) * CAST(35 + 5 * ({key} % 9) AS DECIMAL(3,0)) "
        f"* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS DOUBLE)"
    )


def _segment(vip_orders: int, regular_orders: int, r: str, f: str, m: str) -> str:
    return (
        f"CASE WHEN {r} <= 90 AND {f} >= {vip_orders} AND {m} > {P.VIP_AMOUNT} THEN 'VIP' "
        f"WHEN {r} <= 180 AND {f} >= {regular_orders} THEN 'Regular' "
        f"WHEN {r} <= 365 THEN 'En riesgo' ELSE 'Perdido' END"
    )


def _margin(price: str, cost: str) -> str:
    return f"CAST(round_even(({price} - {cost}) / {price} * 100, 0) AS INTEGER)"


VIEWS: dict[str, str] = {
    "v_ciudad": """
        SELECT CAST(n_nationkey AS BIGINT) AS id_ciudad, n_name AS nombre, r_name AS region,
               CASE r_regionkey % 4 WHEN 0 THEN 'Centro' WHEN 1 THEN 'Norte' WHEN 2 THEN 'Occidente'
                    ELSE 'Oriente' END AS zona
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_categoria": """
        SELECT p_type AS nombre, row_number() OVER (ORDER BY p_type) AS id_categoria
        FROM (SELECT DISTINCT p_type FROM part)""",
    "v_proveedor": """
        SELECT s_suppkey AS id_proveedor, s_name AS nombre, n_name AS pais
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "v_proveedor_ext": """
        SELECT c_custkey AS id_proveedor_ext, c_name AS nombre_empresa, n_name AS pais
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_producto": f"""
        SELECT p_partkey AS id_producto, p_name || '-' || p_partkey AS nombre, id_categoria,
               p_partkey % (SELECT count(*) FROM supplier) AS id_proveedor, p_retailprice AS precio_unitario,
               {_cost("p_retailprice", "p_partkey")} AS costo_unitario, p_size % 12 <> 0 AS activo
        FROM part JOIN v_categoria ON nombre = p_type""",
    "v_cliente": """
        SELECT c_custkey AS id_cliente, c_name AS nombre,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email, CAST(c_nationkey AS BIGINT) AS id_ciudad,
               DATE '1993-01-01' + CAST(c_custkey % 700 AS INTEGER) AS fecha_registro, c_mktsegment AS segmento,
               CAST(c_custkey % 60 + 18 AS INTEGER) AS edad,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS genero
        FROM customer""",
    "v_tienda": """
        SELECT s_suppkey AS id_tienda, s_name AS nombre, CAST(s_nationkey AS BIGINT) AS id_ciudad,
               CASE WHEN s_suppkey % 5 = 0 THEN 'Virtual' ELSE 'Física' END AS tipo, s_suppkey % 750 + 50 AS tamano_m2
        FROM supplier""",
    "v_empleado": """
        SELECT c_custkey AS id_empleado, c_name AS nombre, c_mktsegment AS cargo,
               c_custkey % ((SELECT count(*) FROM supplier) + 1) AS id_tienda,
               DATE '1990-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS fecha_contratacion, c_acctbal AS salario
        FROM customer""",
    "v_metodo_pago": """
        SELECT CAST(o_orderpriority[1] AS BIGINT) AS id_metodo_pago, substr(o_orderpriority, 3) AS nombre,
               CAST(CAST(o_orderpriority[1] AS BIGINT) * 6 + 5 AS DOUBLE) / 10 AS comision_pct
        FROM (SELECT DISTINCT o_orderpriority FROM orders)""",
    "v_orden": """
        SELECT o_orderkey AS id_orden, o_custkey AS id_cliente,
               o_orderkey % (SELECT count(*) FROM customer) AS id_empleado,
               CAST(o_orderpriority[1] AS BIGINT) AS id_metodo_pago,
               CAST(o_orderdate + to_hours(o_orderkey % 24) AS TIMESTAMP) AS fecha_orden,
               CASE o_orderstatus WHEN 'F' THEN 'Completada' WHEN 'O' THEN 'Pendiente' ELSE 'Cancelada' END AS estado
        FROM orders""",
    "v_detalle": """
        SELECT l_orderkey * 10 + l_linenumber AS id_detalle, l_orderkey AS id_orden, l_partkey AS id_producto,
               l_suppkey AS id_tienda, CAST(l_quantity AS BIGINT) AS cantidad,
               l_extendedprice / l_quantity AS precio_unitario, l_discount AS descuento,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(1,0)) - CAST(l_discount AS DECIMAL(4,2)))
                    AS DECIMAL(18,4)) AS subtotal,
               l_returnflag = 'R' AS devuelto
        FROM lineitem""",
    "v_historico": f"""
        SELECT id_producto * 100000 + q AS id_historico_precio, id_producto, centavos / 100 AS precio,
               {_cost("centavos / 100", "id_producto")} AS costo,
               make_date(CAST(q // 4 AS BIGINT), CAST(q % 4 * 3 + 1 AS BIGINT), CAST(1 AS BIGINT)) AS fecha_inicio
        FROM (SELECT l_partkey AS id_producto, year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS q,
                     max(floor(l_extendedprice / l_quantity * 100)) AS centavos
              FROM lineitem GROUP BY ALL)""",
    "v_promocion": """
        SELECT s_suppkey AS id_promocion, 'Oferta ' || s_name AS nombre,
               CASE WHEN s_suppkey % 3 = 0 THEN 'Fijo' ELSE 'Porcentaje' END AS tipo,
               s_suppkey % 17 + 3 AS valor,
               DATE '1995-01-01' + CAST(CASE WHEN s_suppkey % 100 IN (7, 9) THEN 2000 + s_suppkey % 300
                                             ELSE s_suppkey * 37 % 2400 END AS INTEGER) AS fecha_inicio,
               CASE s_suppkey % 100 WHEN 7 THEN NULL WHEN 9 THEN DATE '9999-12-31'
                    ELSE DATE '1995-01-01' + CAST(s_suppkey * 37 % 2400 + s_suppkey % 21 AS INTEGER) END AS fecha_fin,
               s_suppkey % 4 <> 0 AS activa
        FROM supplier""",
    # --- star -----------------------------------------------------------------
    "dim_tiempo": """
        SELECT row_number() OVER (ORDER BY d) AS id_tiempo, CAST(d AS DATE) AS fecha,
               CAST(year(d) AS INTEGER) AS anio, CAST(month(d) AS INTEGER) AS mes, monthname(d) AS nombre_mes,
               CAST(quarter(d) AS INTEGER) AS trimestre, CAST(weekofyear(d) AS INTEGER) AS semana,
               CAST(isodow(d) - 1 AS INTEGER) AS dia_semana, dayname(d) AS nombre_dia, isodow(d) >= 6 AS es_fin_semana,
               CASE WHEN month(d) IN (12, 1, 2) THEN 'Invierno' WHEN month(d) IN (3, 4, 5) THEN 'Primavera'
                    WHEN month(d) IN (6, 7, 8) THEN 'Verano' ELSE 'Otoño' END AS estacion,
               CAST(d AS DATE) AS fecha_date
        FROM (SELECT unnest(generate_series(CAST(min(fecha_orden) AS DATE), CAST(max(fecha_orden) AS DATE),
                                            INTERVAL 1 DAY)) AS d FROM v_orden)""",
    "dim_producto": f"""
        SELECT p.id_producto, p.nombre AS nombre_producto, p.id_categoria, c.nombre AS nombre_categoria,
               p.id_proveedor, s.nombre AS nombre_proveedor, p.precio_unitario, p.costo_unitario, p.activo,
               {_margin("p.precio_unitario", "p.costo_unitario")} AS margen_pct
        FROM v_producto p JOIN v_categoria c USING (id_categoria) JOIN v_proveedor s USING (id_proveedor)""",
    "rfm": """
        SELECT id_cliente, max(fecha_orden) AS ultima_compra, count(DISTINCT id_orden) AS frecuencia,
               count(id_orden) AS monetario,
               date_sub('day', max(fecha_orden), (SELECT max(fecha_orden) FROM v_orden)) AS recency
        FROM v_orden GROUP BY id_cliente""",
    "monto": """
        SELECT id_cliente, CAST(sum(subtotal) AS DOUBLE) AS monto_total
        FROM v_detalle JOIN v_orden USING (id_orden) GROUP BY id_cliente""",
    "dim_cliente": f"""
        SELECT *, {_segment(6, 4, "recency", "frecuencia", "monto_total")} AS segmento_rfm FROM (
            SELECT c.id_cliente, c.nombre AS nombre_cliente, c.email, c.id_ciudad, c.fecha_registro, c.segmento,
                   c.edad, c.genero, u.nombre AS nombre_ciudad, u.region, u.zona, r.ultima_compra,
                   coalesce(r.frecuencia, 0) AS frecuencia, r.monetario, coalesce(r.recency, 999) AS recency,
                   CAST(trunc(coalesce(m.monto_total, 0)) AS BIGINT) AS monto_total
            FROM v_cliente c JOIN v_ciudad u USING (id_ciudad) LEFT JOIN rfm r USING (id_cliente)
                 LEFT JOIN monto m USING (id_cliente))""",
    "dim_tienda": """
        SELECT id_tienda, t.nombre AS nombre_tienda, id_ciudad, tipo, tamano_m2, u.nombre AS nombre_ciudad, region, zona
        FROM v_tienda t JOIN v_ciudad u USING (id_ciudad)""",
    "dim_proveedor": """
        SELECT *, row_number() OVER (ORDER BY tipo DESC, id_proveedor_origen) AS id_proveedor_dw FROM (
            SELECT id_proveedor AS id_proveedor_origen, nombre, pais, 'Interno' AS tipo FROM v_proveedor
            UNION ALL
            SELECT id_proveedor_ext, nombre_empresa, pais, 'Externo' FROM v_proveedor_ext)""",
    "campana": f"""
        SELECT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS id, 'Campaña & más ' || s_name AS nombre,
               CASE s_suppkey % 3 WHEN 0 THEN 'Descuento' WHEN 1 THEN 'Online' ELSE 'Estacional' END AS tipo,
               DATE '{P.FIRST_DAY}' + CAST(s_suppkey AS INTEGER) AS inicio,
               CASE WHEN s_suppkey % 4 <> 0 THEN DATE '{P.FIRST_DAY}' + CAST(s_suppkey AS INTEGER) + 7 END AS fin,
               CAST((s_suppkey % 50 + 1) * 1000 AS DOUBLE) AS presupuesto, 'LARGE,PROMO' AS categorias,
               CAST(s_suppkey % 45 AS DOUBLE) AS incremento_ventas_pct
        FROM supplier""",
    "fact": """
        SELECT d.id_detalle, d.id_orden, d.id_producto, o.id_cliente, o.id_empleado, d.id_tienda, o.id_metodo_pago,
               t.id_tiempo, d.cantidad, d.precio_unitario, d.descuento, d.subtotal, o.fecha_orden, o.estado
        FROM v_detalle d JOIN v_orden o USING (id_orden) JOIN dim_tiempo t ON t.fecha_date = CAST(o.fecha_orden AS DATE)""",
    "star": """
        SELECT f.*, t.anio, t.mes, t.nombre_mes, t.trimestre, p.nombre_producto, p.nombre_categoria, p.margen_pct,
               s.nombre_ciudad AS ciudad_tienda, s.zona AS zona_tienda, s.tipo AS tipo_tienda
        FROM fact f JOIN dim_tiempo t USING (id_tiempo) JOIN dim_producto p USING (id_producto)
             JOIN dim_tienda s USING (id_tienda)""",
    # --- history --------------------------------------------------------------
    "vigencia": """
        SELECT *, lead(fecha_inicio) OVER (PARTITION BY id_producto ORDER BY fecha_inicio, id_historico_precio) AS fecha_fin
        FROM v_historico""",
    "ultimo": """
        SELECT * FROM v_historico
        QUALIFY row_number() OVER (PARTITION BY id_producto ORDER BY fecha_inicio DESC, id_historico_precio DESC) = 1""",
    "precio_actual": """
        SELECT p.id_producto, coalesce(u.precio, p.precio_unitario) AS precio, coalesce(u.costo, p.costo_unitario) AS costo,
               u.fecha_inicio, u.id_historico_precio
        FROM v_producto p LEFT JOIN ultimo u USING (id_producto)""",
    "corte": f"""
        SELECT DATE '{P.FIRST_CUTOFF}' AS corte
        UNION ALL
        SELECT e FROM (SELECT e, lag(e) OVER (ORDER BY e) AS previo FROM (
            SELECT make_date(y, m, d) AS e FROM range({P.FIRST_CUTOFF.year}, 2200) a(y), (VALUES (6, 30), (12, 31)) b(m, d)))
        WHERE previo IS NULL OR CAST(previo AS TIMESTAMP) < (SELECT max(fecha_orden) FROM v_orden)""",
    "rfm_corte": """
        SELECT c.id_cliente, corte,
               coalesce(date_sub('day', max(fecha_orden), CAST(corte AS TIMESTAMP)), 999) AS recency,
               count(DISTINCT id_orden) AS frecuencia, coalesce(CAST(sum(monto) AS DOUBLE), 0) AS monto
        FROM v_cliente c CROSS JOIN corte
             LEFT JOIN (SELECT o.id_cliente, o.id_orden, o.fecha_orden, sum(d.subtotal) AS monto
                        FROM v_orden o LEFT JOIN v_detalle d USING (id_orden) GROUP BY ALL) h
                  ON h.id_cliente = c.id_cliente AND h.fecha_orden <= corte
        GROUP BY c.id_cliente, corte""",
    "scd_cliente": f"""
        SELECT v.id_cliente, v.segmento_rfm, v.recency, v.frecuencia, v.monto, v.corte,
               row_number() OVER k AS version, lead(corte) OVER k AS siguiente
        FROM (SELECT *, lag(segmento_rfm) OVER (PARTITION BY id_cliente ORDER BY corte) AS antes
              FROM (SELECT *, {_segment(5, 2, "recency", "frecuencia", "monto")} AS segmento_rfm FROM rfm_corte)) v
        WHERE antes IS NULL OR antes <> segmento_rfm
        WINDOW k AS (PARTITION BY id_cliente ORDER BY corte)""",
    "scd_cliente_dim": """
        SELECT row_number() OVER (ORDER BY s.id_cliente, version) AS id_cliente_sk, s.id_cliente AS id_cliente_nk,
               c.nombre AS nombre_cliente, c.email, u.nombre AS nombre_ciudad, u.region, u.zona, c.edad, c.genero,
               c.fecha_registro, s.segmento_rfm, s.recency AS recency_dias, s.frecuencia AS frecuencia_compras,
               CAST(trunc(s.monto) AS BIGINT) AS monto_total, s.corte AS fecha_inicio, DATE '9999-12-31' AS fecha_fin,
               CAST(siguiente IS NULL AS INTEGER) AS es_actual, CAST(version AS INTEGER) AS version, siguiente
        FROM scd_cliente s JOIN v_cliente c USING (id_cliente) JOIN v_ciudad u USING (id_ciudad)""",
    # --- cube -----------------------------------------------------------------
    "base": """
        SELECT d.id_detalle, d.id_orden, d.id_producto, o.id_cliente, o.id_empleado, d.id_tienda, o.id_metodo_pago,
               c.id_categoria, c.nombre AS categoria, CAST(o.fecha_orden AS DATE) AS fecha_date,
               CAST(year(o.fecha_orden) AS INTEGER) AS anio, CAST(month(o.fecha_orden) AS INTEGER) AS mes,
               CAST(quarter(o.fecha_orden) AS INTEGER) AS trimestre, d.cantidad, d.precio_unitario, d.descuento,
               d.subtotal, o.estado
        FROM v_detalle d JOIN v_orden o USING (id_orden)
             LEFT JOIN (SELECT id_producto, id_categoria, c.nombre FROM v_producto JOIN v_categoria c USING (id_categoria)) c
                  USING (id_producto)""",
    # --- KPIs -----------------------------------------------------------------
    "anual": """
        SELECT *, round_even((ventas - lag(ventas) OVER (ORDER BY anio)) / lag(ventas) OVER (ORDER BY anio) * 100, 1)
                  AS crecimiento_yoy_pct
        FROM (SELECT anio, CAST(sum(subtotal) AS DOUBLE) AS ventas, count(DISTINCT id_orden) AS ordenes
              FROM star GROUP BY anio)""",
    "margen": """
        SELECT *, round_even((ingresos - costo_estimado) / ingresos * 100, 1) AS margen_real_pct FROM (
            SELECT nombre_categoria, CAST(sum(subtotal) AS DOUBLE) AS ingresos,
                   CAST(sum(subtotal * CAST(100 - margen_pct AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))) AS DOUBLE)
                       AS costo_estimado,
                   avg(margen_pct) AS margen_promedio, CAST(sum(cantidad) AS BIGINT) AS unidades
            FROM star GROUP BY nombre_categoria)""",
    # --- mining ---------------------------------------------------------------
    "perfil": """
        SELECT id_producto, nombre_producto, nombre_categoria, CAST(sum(cantidad) AS BIGINT) AS cantidad,
               CAST(sum(subtotal) AS DOUBLE) AS ventas, count(*) AS lineas,
               count(*) FILTER (devuelto) AS lineas_devueltas,
               CAST(sum(subtotal) AS DOUBLE) / CAST(sum(cantidad) AS DOUBLE) AS precio_promedio
        FROM v_detalle JOIN dim_producto USING (id_producto) GROUP BY ALL""",
    "riesgo": f"""
        SELECT *, round(greatest(0.01, least(0.35, CAST(0.05 AS DOUBLE)
                    + CASE WHEN precio_promedio > {P.HIGH_PRICE} THEN CAST(0.15 AS DOUBLE) ELSE 0 END
                    + CASE WHEN nombre_categoria IN ({_risky}) THEN CAST(0.10 AS DOUBLE) ELSE 0 END)), 6) AS prob_devolucion,
               dense_rank() OVER (ORDER BY nombre_categoria) - 1 AS categoria_cod
        FROM perfil""",
    "bayes": f"""
        SELECT id_producto, precio_promedio, CAST(cantidad AS DOUBLE) AS cantidad,
               CAST(categoria_cod AS DOUBLE) AS categoria_cod,
               CAST(prob_devolucion >= {P.RISK_THRESHOLD} AS INTEGER) AS riesgo
        FROM riesgo""",
    "bayes_largo": """
        UNPIVOT bayes ON precio_promedio, cantidad, categoria_cod INTO NAME feature VALUE x""",
    "modelo": """
        SELECT riesgo AS clase, feature, count(*) AS n,
               count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM bayes) AS prior, avg(x) AS media,
               var_pop(x) + (SELECT 1e-9 * max(v) FROM (SELECT var_pop(x) AS v FROM bayes_largo GROUP BY feature))
                   AS varianza
        FROM bayes_largo GROUP BY riesgo, feature""",
    "puntaje": """
        SELECT b.id_producto, b.riesgo, m.clase,
               any_value(ln(m.prior)) + sum(-0.5 * ln(2 * pi() * m.varianza) - (b.x - m.media) ** 2 / (2 * m.varianza)) AS ll
        FROM bayes_largo b JOIN modelo m USING (feature) GROUP BY b.id_producto, b.riesgo, m.clase""",
    "pliegue": f"""
        SELECT l.*, (row_number() OVER (PARTITION BY riesgo, feature ORDER BY h, id_producto) - 1) % {P.FOLDS} AS fold,
               h % 100 < 70 AS es_entrenamiento
        FROM (SELECT *, CAST('0x' || substr(md5(id_producto || '-{P.SEED}'), 1, 8) AS BIGINT) AS h FROM bayes_largo) l""",
    "ronda": f"""
        SELECT r, id_producto, riesgo, feature, x, fold <> r AS aprende
        FROM pliegue CROSS JOIN (SELECT unnest(range({P.FOLDS})) AS r)
        UNION ALL
        SELECT -1, id_producto, riesgo, feature, x, es_entrenamiento FROM pliegue""",
    "ronda_modelo": """
        SELECT *, var_clase + 1e-9 * max(var_total) OVER (PARTITION BY r) AS varianza,
               n / sum(n) OVER (PARTITION BY r, feature) AS prior
        FROM (SELECT r, riesgo AS clase, feature, CAST(count(*) AS DOUBLE) AS n, avg(x) AS media, var_pop(x) AS var_clase
              FROM ronda WHERE aprende GROUP BY ALL)
             JOIN (SELECT r, feature, var_pop(x) AS var_total FROM ronda WHERE aprende GROUP BY ALL) USING (r, feature)""",
    "ronda_puntaje": """
        SELECT d.r, d.id_producto, d.riesgo, m.clase,
               any_value(ln(m.prior)) + sum(-0.5 * ln(2 * pi() * m.varianza) - (d.x - m.media) ** 2 / (2 * m.varianza)) AS ll
        FROM ronda d JOIN ronda_modelo m USING (r, feature) WHERE NOT d.aprende GROUP BY ALL""",
    "ronda_exactitud": """
        SELECT r, count(*) AS n, avg(CAST(riesgo = clase AS INTEGER)) AS exactitud
        FROM (SELECT r, id_producto, riesgo, arg_min(clase, (-ll, clase)) AS clase FROM ronda_puntaje GROUP BY ALL)
        GROUP BY r""",
    "semanal": """
        SELECT g.i, g.semana_fin, coalesce(v.ventas, 0) AS ventas, coalesce(v.transacciones, 0) AS transacciones
        FROM (SELECT CAST(row_number() OVER (ORDER BY d) - 1 AS INTEGER) AS i, CAST(d AS DATE) AS semana_fin
              FROM (SELECT unnest(generate_series(min(s), max(s), INTERVAL 7 DAY)) AS d
                    FROM (SELECT CAST(fecha_orden AS DATE) + CAST(7 - isodow(fecha_orden) AS INTEGER) AS s FROM fact))) g
             LEFT JOIN (SELECT CAST(fecha_orden AS DATE) + CAST(7 - isodow(fecha_orden) AS INTEGER) AS semana_fin,
                               CAST(sum(subtotal) AS DOUBLE) AS ventas, count(DISTINCT id_orden) AS transacciones
                        FROM fact GROUP BY ALL) v USING (semana_fin)""",
    "semanal_categoria": """
        SELECT g.nombre_categoria, g.i, g.semana_fin, coalesce(v.ventas, 0) AS ventas
        FROM (SELECT nombre_categoria, CAST(row_number() OVER (PARTITION BY nombre_categoria ORDER BY d) - 1 AS INTEGER) AS i,
                     CAST(d AS DATE) AS semana_fin
              FROM (SELECT nombre_categoria, unnest(generate_series(min(s), max(s), INTERVAL 7 DAY)) AS d
                    FROM (SELECT nombre_categoria, CAST(fecha_orden AS DATE) + CAST(7 - isodow(fecha_orden) AS INTEGER) AS s
                          FROM star) GROUP BY nombre_categoria)) g
             LEFT JOIN (SELECT nombre_categoria, CAST(fecha_orden AS DATE) + CAST(7 - isodow(fecha_orden) AS INTEGER) AS semana_fin,
                               CAST(sum(subtotal) AS DOUBLE) AS ventas
                        FROM star GROUP BY ALL) v USING (nombre_categoria, semana_fin)""",
    "mensual": """
        SELECT anio, mes, nombre_categoria, CAST(sum(subtotal) AS DOUBLE) AS ventas FROM star GROUP BY ALL""",
    "celdas": """
        SELECT m.anio, m.mes, c.nombre AS columna, coalesce(v.ventas, 0) AS ventas
        FROM (SELECT DISTINCT anio, mes FROM mensual) m CROSS JOIN v_categoria c
             LEFT JOIN mensual v ON v.anio = m.anio AND v.mes = m.mes AND v.nombre_categoria = c.nombre
        UNION ALL
        SELECT anio, mes, 'total_ventas', sum(ventas) FROM mensual GROUP BY anio, mes""",
    "correlaciones": """
        SELECT x.columna AS a, y.columna AS b, corr(x.ventas, y.ventas) AS correlacion
        FROM celdas x JOIN celdas y USING (anio, mes)
        WHERE x.columna <= y.columna GROUP BY ALL""",
}


def _itemset_views(item: str, support: float, depth: int = 6) -> dict[str, str]:
    """Item sets of up to ``depth`` items by self-joins, each level from the frequent sets below it."""
    views = {
        "pares": f"""
        SELECT DISTINCT l_orderkey AS o, {item} AS x FROM lineitem JOIN part ON l_partkey = p_partkey""",
        "total": "SELECT count(DISTINCT o) AS n FROM pares",
        "n1": f"""
        SELECT [x] AS s, count(*) AS c FROM pares GROUP BY x HAVING count(*) >= {support} * (SELECT n FROM total)""",
        "o1": "SELECT o, [x] AS s FROM pares WHERE [x] IN (SELECT s FROM n1)",
    }
    for k in range(2, depth + 1):
        views[f"c{k}"] = f"""
        SELECT a.o, list_append(a.s, b.x) AS s FROM o{k - 1} a JOIN pares b ON a.o = b.o AND b.x > a.s[-1]"""
        views[f"n{k}"] = f"""
        SELECT s, count(*) AS c FROM c{k} GROUP BY s HAVING count(*) >= {support} * (SELECT n FROM total)"""
        views[f"o{k}"] = f"SELECT o, s FROM c{k} WHERE s IN (SELECT s FROM n{k})"
    union = " UNION ALL ".join(f"SELECT * FROM n{k}" for k in range(1, depth + 1))
    views["conjuntos"] = f"SELECT s, c, c / CAST((SELECT n FROM total) AS DOUBLE) AS soporte FROM ({union})"
    views["mascaras"] = f"SELECT unnest(range(1, {2**depth})) AS m"
    views["reglas"] = """
        SELECT r.*, soporte / soporte_a AS confianza, soporte / soporte_a / soporte_c AS lift FROM (
            SELECT p.a, p.k, p.soporte, x.soporte AS soporte_a, y.soporte AS soporte_c
            FROM (SELECT s, soporte,
                         [e FOR e IN s IF (m >> (list_position(s, e) - 1)) & 1 = 1] AS a,
                         [e FOR e IN s IF (m >> (list_position(s, e) - 1)) & 1 = 0] AS k
                  FROM conjuntos JOIN mascaras ON m < (1 << len(s)) - 1 WHERE len(s) > 1) p
                 JOIN conjuntos x ON x.s = p.a JOIN conjuntos y ON y.s = p.k) r
        WHERE soporte / soporte_a / soporte_c >= 1"""
    return views


BRANDS = _itemset_views("p_brand", P.BRAND_SUPPORT, depth=4)
TYPES = _itemset_views("p_type", P.TYPE_SUPPORT)

_MEASURES = """CAST(sum(cantidad) AS BIGINT) AS cantidad_vendida, CAST(sum(subtotal) AS DOUBLE) AS ventas_totales,
               CAST(sum(CAST(descuento AS DECIMAL(9,4))) AS DOUBLE) AS descuento_total,
               count(DISTINCT id_orden) AS transacciones,
               CAST(sum(subtotal) AS DOUBLE) / count(*) AS ticket_promedio"""
_SALES = "CAST(sum(subtotal) AS DOUBLE) AS ventas, CAST(sum(cantidad) AS BIGINT) AS cantidad"


def _decompose(source: str, series: str = "") -> str:
    part = f"PARTITION BY {series}" if series else ""
    comma = f"{series}, " if series else ""
    using = f"USING ({series})" if series else "ON TRUE"
    return f"""
        WITH t AS (
            SELECT *, CASE WHEN i >= 26 AND i < n - 26 THEN
                       (sum(ventas) OVER (w ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)
                        - 0.5 * lag(ventas, 26) OVER w - 0.5 * lead(ventas, 26) OVER w) / 52 END AS tendencia
            FROM (SELECT *, count(*) OVER ({part}) AS n FROM {source})
            WINDOW w AS ({part} ORDER BY i)),
        f AS (SELECT {comma}i % 52 AS fase, avg(ventas - tendencia) AS m FROM t GROUP BY {comma}i % 52),
        g AS (SELECT {comma}avg(m) AS nivel FROM f {f"GROUP BY {series}" if series else ""})
        SELECT {f"t.{series}, " if series else ""}t.i, t.semana_fin, t.ventas AS observado, round(t.tendencia, 1) AS tendencia,
               round(f.m - g.nivel, 1) AS estacional,
               round(t.ventas - t.tendencia - (f.m - g.nivel), 1) AS residuo
        FROM t JOIN f ON f.fase = t.i % 52 {f"AND f.{series} = t.{series}" if series else ""}
             JOIN g {f"ON g.{series} = t.{series}" if series else using}"""


_months = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]

_listing = {
    "categorias": ("v_categoria", "nombre id_categoria"),
    "ciudades": ("v_ciudad", "id_ciudad nombre region zona"),
    "clientes": ("v_cliente", "id_cliente nombre email id_ciudad fecha_registro segmento edad genero"),
    "detalleordenes": (
        "v_detalle",
        "id_detalle id_orden id_producto id_tienda cantidad precio_unitario descuento subtotal devuelto",
    ),
    "empleados": ("v_empleado", "id_empleado nombre cargo id_tienda fecha_contratacion salario"),
    "historicoprecios": ("v_historico", "id_historico_precio id_producto precio costo fecha_inicio"),
    "metodospago": ("v_metodo_pago", "id_metodo_pago nombre comision_pct"),
    "ordenes": ("v_orden", "id_orden id_cliente id_empleado id_metodo_pago fecha_orden estado"),
    "productos": (
        "v_producto",
        "id_producto nombre id_categoria id_proveedor precio_unitario costo_unitario activo",
    ),
    "proveedores": ("v_proveedor", "id_proveedor nombre pais"),
    "tiendas": ("v_tienda", "id_tienda nombre id_ciudad tipo tamano_m2"),
}
_counts = " UNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM {v}" for t, (v, _) in _listing.items())
_columns = ", ".join(
    f"('{t}', {i}, '{c}', {str(c == next(x for x in cols.split() if x.startswith('id_'))).upper()})"
    for t, (_, cols) in _listing.items()
    for i, c in enumerate(cols.split(), 1)
)
_relations = [
    ("clientes", "id_ciudad", "ciudades"),
    ("detalleordenes", "id_orden", "ordenes"),
    ("detalleordenes", "id_producto", "productos"),
    ("detalleordenes", "id_tienda", "tiendas"),
    ("empleados", "id_tienda", "tiendas"),
    ("historicoprecios", "id_producto", "productos"),
    ("ordenes", "id_cliente", "clientes"),
    ("ordenes", "id_empleado", "empleados"),
    ("ordenes", "id_metodo_pago", "metodospago"),
    ("productos", "id_categoria", "categorias"),
    ("productos", "id_proveedor", "proveedores"),
    ("tiendas", "id_ciudad", "ciudades"),
]
_orphans = " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, '{c}' AS columna, '{r}' AS referencia, count(*) AS huerfanos "
    f"FROM {_listing[t][0]} WHERE {c} NOT IN (SELECT {c} FROM {_listing[r][0]})"
    for t, c, r in _relations
)
_manifest = [
    ("Dim_Tiempo", "dim_tiempo"),
    ("Dim_Producto", "dim_producto"),
    ("Dim_Cliente", "dim_cliente"),
    ("Dim_Tienda", "dim_tienda"),
    ("Dim_Empleado", "dim_empleado_inner"),
    ("Dim_MetodoPago", "v_metodo_pago"),
    ("Dim_Proveedor", "dim_proveedor"),
    ("Dim_Campana", "campana"),
    ("Fact_Ventas", "fact"),
]
VIEWS["dim_empleado_inner"] = """
        SELECT e.id_empleado, e.nombre AS nombre_empleado, e.cargo, e.id_tienda, e.fecha_contratacion, e.salario,
               t.nombre AS nombre_tienda
        FROM v_empleado e JOIN v_tienda t USING (id_tienda)"""
VIEWS["manifiesto"] = " UNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM {v}" for t, v in _manifest)


def _scd_product(strict: bool) -> str:
    start = f"coalesce(a.fecha_inicio, DATE '{P.FIRST_DAY}')" if strict else f"DATE '{P.FIRST_DAY}'"
    return f"""
        SELECT row_number() OVER (ORDER BY es_actual DESC, id_producto_nk, fecha_inicio, orden) AS id_producto_sk,
               * EXCLUDE (orden) FROM (
            SELECT p.id_producto AS id_producto_nk, p.nombre_producto, p.id_categoria, p.nombre_categoria,
                   p.id_proveedor, p.nombre_proveedor, v.precio AS precio_unitario, v.costo AS costo_unitario,
                   CASE WHEN v.precio > 0 THEN {_margin("v.precio", "v.costo")} ELSE 0 END AS margen_pct, p.activo,
                   v.fecha_inicio, v.fecha_fin, v.es_actual, v.orden
            FROM dim_producto p JOIN (
                SELECT a.id_producto, a.precio, a.costo, {start} AS fecha_inicio, DATE '9999-12-31' AS fecha_fin,
                       1 AS es_actual, 0 AS orden FROM precio_actual a
                UNION ALL
                SELECT h.id_producto, h.precio, h.costo, h.fecha_inicio, coalesce(h.fecha_fin, u.fecha_inicio), 0,
                       h.id_historico_precio
                FROM vigencia h JOIN ultimo u USING (id_producto)
                WHERE h.id_historico_precio <> u.id_historico_precio) v USING (id_producto))"""


_promo = """
        SELECT id_orden, fecha_orden, CAST(id_promocion AS BIGINT) AS id_promocion, tipo, CAST(valor AS BIGINT) AS valor, fecha_inicio, fecha_fin
        FROM v_orden JOIN v_promocion ON fecha_orden >= fecha_inicio AND (fecha_orden <= fecha_fin OR fecha_fin IS NULL)
        WHERE activa"""
VIEWS["promo"] = _promo
VIEWS["escalado"] = """
        SELECT id_cliente, segmento_rfm, monto_total,
               (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS x,
               (frecuencia - avg(frecuencia) OVER ()) / stddev_pop(frecuencia) OVER () AS y,
               (monto_total - avg(monto_total) OVER ()) / stddev_pop(monto_total) OVER () AS z
        FROM dim_cliente"""
VIEWS["bandas"] = f"""
        SELECT e.*, k, CAST(least(k - 1, floor((monto_total - lo) / ((hi - lo) / CAST(k AS DOUBLE)))) AS INTEGER) AS c
        FROM escalado e, (SELECT min(monto_total) AS lo, max(monto_total) AS hi FROM escalado) m,
             (VALUES {", ".join(f"({k})" for k in P.BANDS)}) AS t(k)"""


def _inertia(source: str, keys: str) -> str:
    return f"""
        SELECT {keys}, count(*) AS n,
               sum((x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz)) AS inercia
        FROM (SELECT *, avg(x) OVER p AS mx, avg(y) OVER p AS my, avg(z) OVER p AS mz FROM {source}
              WINDOW p AS (PARTITION BY {keys})) GROUP BY {keys}"""


def _silhouette(source: str, family: str, cluster: str) -> str:
    """Every point against every other; its own cluster without itself."""
    near = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)"
    return f"""
        SELECT f, g, CASE WHEN own IS NULL OR other IS NULL THEN 0
                          ELSE coalesce((other - own) / nullif(greatest(other, own), 0), 0) END AS s
        FROM (SELECT f, g, id_cliente, max(d) FILTER (g = h) AS own, min(d) FILTER (g <> h) AS other FROM (
                SELECT a.{family} AS f, a.{cluster} AS g, a.id_cliente, b.{cluster} AS h,
                       sum({near}) / nullif(count(*) - CASE WHEN any_value(a.{cluster} = b.{cluster}) THEN 1 ELSE 0 END, 0) AS d
                FROM {source} a JOIN {source} b ON a.{family} = b.{family} GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)"""


VIEWS["un_grupo"] = "SELECT *, 1 AS uno FROM escalado"
VIEWS["silueta_segmento"] = _silhouette("un_grupo", "uno", "segmento_rfm")
VIEWS["silueta_banda"] = _silhouette("bandas", "k", "c")
VIEWS["inercia_banda"] = _inertia("bandas", "k, c")
VIEWS["codo_banda"] = """
        SELECT i.k, round(i.v, 4) AS inercia, round(s.v, 6) AS silueta
        FROM (SELECT k, sum(inercia) AS v FROM inercia_banda GROUP BY k) i
             JOIN (SELECT f, avg(s) AS v FROM silueta_banda GROUP BY f) s ON s.f = i.k"""
VIEWS["rasgos"] = """
        SELECT c.id_cliente, c.recency, c.frecuencia, c.monto_total,
               coalesce(h.devueltas / CAST(nullif(h.lineas, 0) AS DOUBLE), 0) AS tasa,
               coalesce(h.dias, 0) AS dias, CAST(c.recency > 180 AS INTEGER) AS churn
        FROM dim_cliente c LEFT JOIN (
            SELECT o.id_cliente, count(d.id_orden) AS lineas, count(*) FILTER (d.devuelto) AS devueltas,
                   date_sub('day', min(o.fecha_orden), (SELECT max(fecha_orden) FROM v_orden)) AS dias
            FROM v_orden o LEFT JOIN v_detalle d USING (id_orden) GROUP BY o.id_cliente) h USING (id_cliente)"""


def _path(node: int, before: list[int]) -> str:
    """The fixed tree as nested cases that name the way to the leaf."""
    _, _, _, feature, limit, _ = P.TREE[node]
    way = [*before, node]
    if feature is None:
        return f"{way}"
    low, high = (next(n[0] for n in P.TREE if n[1] == node and n[2] == side) for side in ("<=", ">"))
    column = {"tasa_devolucion": "tasa", "dias_desde_registro": "dias"}.get(feature, feature)
    return f"CASE WHEN {column} <= {limit} THEN {_path(low, way)} ELSE {_path(high, way)} END"


def _value(v: object) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


VIEWS["arbol"] = "SELECT * FROM (VALUES " + ", ".join(f"({', '.join(map(_value, n))})" for n in P.TREE) + """
        ) AS t(nodo, padre, lado, feature, limite, prediccion)"""
VIEWS["camino"] = f"SELECT *, {_path(0, [])} AS ruta FROM rasgos"
VIEWS["nodos"] = """
        SELECT a.nodo, a.padre, a.lado, a.feature, CAST(a.limite AS DOUBLE) AS limite, coalesce(n, 0) AS filas,
               coalesce(si, 0) AS positivos, coalesce(2 * (si / CAST(n AS DOUBLE)) * (1 - si / CAST(n AS DOUBLE)), 0) AS gini
        FROM arbol a LEFT JOIN (SELECT nodo, count(*) AS n, CAST(sum(churn) AS BIGINT) AS si
                                FROM (SELECT unnest(ruta) AS nodo, churn FROM camino) GROUP BY nodo) USING (nodo)"""
VIEWS["ganancia"] = """
        SELECT p.feature, sum(p.filas * p.gini - h.quedan) AS g
        FROM nodos p JOIN (SELECT padre, sum(filas * gini) AS quedan FROM nodos GROUP BY padre) h ON h.padre = p.nodo
        GROUP BY p.feature"""
VIEWS["regla_fija"] = f"""
        SELECT CAST(recency > 180 AS INTEGER) AS y, CAST(frecuencia < {P.ORDERS_RULE} AS INTEGER) AS p FROM dim_cliente"""
VIEWS["por_clase"] = """
        SELECT c, tp, pr, re, CASE WHEN pr = 0 THEN 0 ELSE tp / CAST(pr AS DOUBLE) END AS pre,
               CASE WHEN re = 0 THEN 0 ELSE tp / CAST(re AS DOUBLE) END AS rec
        FROM (SELECT c, count(*) FILTER (y = c AND p = c) AS tp, count(*) FILTER (p = c) AS pr,
                     count(*) FILTER (y = c) AS re
              FROM regla_fija, (VALUES (0), (1)) AS k(c) GROUP BY c)"""
VIEWS["por_clase_f"] = """
        SELECT *, CASE WHEN pre + rec = 0 THEN 0 ELSE 2 * pre * rec / (pre + rec) END AS f FROM por_clase"""

SQL: dict[str, str] = {
    # --- sources and sinks
    "src_table": "SELECT * FROM orders",
    "src_pruned": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
    "src_csv_roundtrip": "SELECT * FROM part",
    "src_xml": "SELECT * FROM campana",
    "sink_overwrite": "SELECT * FROM dim_tienda",
    "load_manifest": "SELECT * FROM manifiesto UNION ALL SELECT 'TOTAL', CAST(sum(filas) AS BIGINT) FROM manifiesto",
    "sink_csv_export": "SELECT tabla, filas, CAST(NULL AS VARCHAR) AS error FROM manifiesto",
    "dates_coerced": """
        SELECT id_orden, CASE WHEN estado <> 'Cancelada' THEN fecha_orden END AS fecha_orden, estado FROM v_orden""",
    "schema_listing": f"""
        SELECT c.*, n.filas FROM (VALUES {_columns}) AS c(tabla, posicion, columna, es_pk)
             JOIN ({_counts}) n USING (tabla)""",
    "table_counts": f"""
        WITH n AS ({_counts}) SELECT * FROM n UNION ALL SELECT 'TOTAL', CAST(sum(filas) AS BIGINT) FROM n""",
    "fk_orphans": _orphans,
    # --- dimensions and fact
    "dim_date": "SELECT * FROM dim_tiempo",
    "dim_product": "SELECT * FROM dim_producto",
    "rfm_base": "SELECT * FROM rfm",
    "customer_monetary": """
        SELECT id_cliente, coalesce(monto_total, 0) AS monto_total FROM rfm LEFT JOIN monto USING (id_cliente)""",
    "dim_customer_rfm": "SELECT * FROM dim_cliente",
    "dim_store": "SELECT * FROM dim_tienda",
    "dim_employee": "SELECT * FROM dim_empleado_inner",
    "dim_payment": "SELECT * FROM v_metodo_pago",
    "dim_supplier_union": "SELECT * FROM dim_proveedor",
    "dim_campaign": "SELECT *, row_number() OVER (ORDER BY id) AS id_campana_dw FROM campana",
    "fact_sales": """
        SELECT * REPLACE (CAST(subtotal AS DOUBLE) AS subtotal),
               CAST(round_even(CAST(subtotal AS DOUBLE), 0) AS BIGINT) AS subtotal_entero FROM fact""",
    "star_join": """
        SELECT id_detalle, id_orden, id_producto, id_cliente, id_tienda, anio, mes, trimestre, nombre_categoria,
               margen_pct, c.segmento_rfm, c.nombre_ciudad AS ciudad_cliente, c.zona AS zona_cliente, tipo_tienda,
               ciudad_tienda, zona_tienda, cantidad, CAST(subtotal AS DOUBLE) AS subtotal
        FROM star JOIN dim_cliente c USING (id_cliente)""",
    "segment_counts": "SELECT segmento_rfm, count(*) AS clientes FROM dim_cliente GROUP BY segmento_rfm",
    # --- slowly changing dimensions
    "rfm_as_of": "SELECT * FROM rfm_corte",
    "price_current": "SELECT id_producto, precio, costo, fecha_inicio FROM precio_actual",
    "price_validity": "SELECT * FROM vigencia",
    "scd2_product": _scd_product(strict=False),
    "scd2_product_strict": _scd_product(strict=True),
    "scd2_customer": "SELECT * EXCLUDE (siguiente) FROM scd_cliente_dim",
    "scd2_customer_strict": """
        SELECT * EXCLUDE (siguiente) REPLACE (coalesce(siguiente, fecha_fin) AS fecha_fin) FROM scd_cliente_dim""",
    "scd_audit": """
        SELECT 'producto' AS dimension, count(*) AS claves, CAST(sum(n) AS BIGINT) AS versiones,
               count(*) AS actuales, CAST(sum(n) AS BIGINT) - count(*) AS historicas,
               count(*) FILTER (n > 1) AS claves_con_cambios
        FROM (SELECT id_producto, greatest(count(h.id_historico_precio), 1) AS n
              FROM dim_producto LEFT JOIN v_historico h USING (id_producto) GROUP BY id_producto)
        UNION ALL
        SELECT 'cliente', count(*), CAST(sum(n) AS BIGINT), CAST(sum(a) AS BIGINT), CAST(sum(n - a) AS BIGINT),
               count(*) FILTER (n > 1)
        FROM (SELECT id_cliente_nk, count(*) AS n, sum(es_actual) AS a FROM scd_cliente_dim GROUP BY id_cliente_nk)""",
    "scd_example": """
        SELECT id_cliente_sk, id_cliente_nk, segmento_rfm, recency_dias, frecuencia_compras, monto_total, fecha_inicio,
               es_actual
        FROM scd_cliente_dim
        WHERE id_cliente_nk = (SELECT min(id_cliente_nk) FROM scd_cliente_dim WHERE version > 1)""",
    "dim_store_scd1": f"""
        SELECT id_tienda, nombre_tienda, nombre_ciudad, region, zona, tipo, tamano_m2,
               DATE '{P.AUDIT_DAY}' AS ultima_actualizacion FROM dim_tienda""",
    "dim_employee_scd1": f"""
        SELECT e.id_empleado, e.nombre AS nombre_empleado, e.cargo, t.nombre AS nombre_tienda, e.fecha_contratacion,
               e.salario, DATE '{P.AUDIT_DAY}' AS ultima_actualizacion
        FROM v_empleado e LEFT JOIN v_tienda t USING (id_tienda)""",
    "dim_payment_scd1": f"SELECT *, DATE '{P.AUDIT_DAY}' AS ultima_actualizacion FROM v_metodo_pago",
    # --- cube
    "cube_n0": """
        SELECT * EXCLUDE (categoria) REPLACE (CAST(subtotal AS DOUBLE) AS subtotal), 0 AS cubo_nivel FROM base""",
    "cube_n1": f"""
        SELECT id_producto, id_categoria, categoria, fecha_date, anio, mes, trimestre, {_MEASURES},
               round(avg(precio_unitario), 8) AS precio_promedio, 1 AS cubo_nivel
        FROM base WHERE id_categoria IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "cube_n2": f"""
        SELECT id_categoria, categoria, anio, mes, trimestre, {_MEASURES},
               count(DISTINCT id_producto) AS productos_distintos, 2 AS cubo_nivel
        FROM base WHERE id_categoria IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    "cube_n3": f"""
        SELECT id_categoria, categoria, anio, trimestre, {_MEASURES}, 3 AS cubo_nivel
        FROM base WHERE id_categoria IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "cube_n4": f"""
        SELECT anio, {_MEASURES}, count(DISTINCT id_categoria) AS categorias_activas, 'Todas' AS categoria, 4 AS cubo_nivel
        FROM base GROUP BY anio""",
    "cube_grouping_sets": f"""
        SELECT id_producto, id_categoria, categoria, fecha_date, anio, mes, trimestre, {_MEASURES},
               CASE grouping_id(id_producto, id_categoria, categoria, fecha_date, anio, mes, trimestre)
                    WHEN 0 THEN 1 WHEN 72 THEN 2 WHEN 74 THEN 3 WHEN 123 THEN 4 END AS cubo_nivel
        FROM base WHERE id_categoria IS NOT NULL
        GROUP BY GROUPING SETS ((id_producto, id_categoria, categoria, fecha_date, anio, mes, trimestre),
            (id_categoria, categoria, anio, mes, trimestre), (id_categoria, categoria, anio, trimestre), (anio))""",
    "cube_reconcile": """
        SELECT n.nivel, n.filas, t.v AS ventas_totales
        FROM (SELECT 0 AS nivel, count(*) AS filas FROM base
              UNION ALL SELECT 1, count(*) FROM (SELECT DISTINCT id_producto, fecha_date FROM base)
              UNION ALL SELECT 2, count(*) FROM (SELECT DISTINCT id_categoria, anio, mes FROM base)
              UNION ALL SELECT 3, count(*) FROM (SELECT DISTINCT id_categoria, anio, trimestre FROM base)
              UNION ALL SELECT 4, count(DISTINCT anio) FROM base) n,
             (SELECT CAST(sum(subtotal) AS DOUBLE) AS v FROM base) t""",
    # --- OLAP
    "olap_rollup": f"""
        SELECT anio, trimestre, mes, nombre_mes, {_SALES}, count(DISTINCT id_orden) AS transacciones
        FROM star GROUP BY 1, 2, 3, 4""",
    "olap_monthly_series": """
        SELECT anio, mes, nombre_mes, ventas, anio || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS periodo,
               ventas / 1000000 AS ventas_mm
        FROM (SELECT anio, mes, nombre_mes, CAST(sum(subtotal) AS DOUBLE) AS ventas FROM star GROUP BY 1, 2, 3)""",
    "olap_slice": f"""
        SELECT *, ventas / 1000000 AS ventas_mm FROM (
            SELECT anio, {_SALES} FROM star WHERE nombre_categoria = '{P.SLICE_CATEGORY}' GROUP BY anio)""",
    "olap_dice": f"""
        SELECT nombre_mes, {_SALES} FROM star
        WHERE nombre_categoria = '{P.DICE["nombre_categoria"]}' AND ciudad_tienda = '{P.DICE["ciudad_tienda"]}'
              AND anio = {P.DICE["anio"]} GROUP BY nombre_mes""",
    "olap_drilldown": "SELECT anio, trimestre, "
    + ", ".join(
        f"CAST(trunc(CAST(coalesce(sum(subtotal) FILTER (nombre_mes = '{m}'), 0) AS DOUBLE)) AS BIGINT) AS {m}" for m in _months
    )
    + f" FROM star WHERE nombre_categoria = '{P.DRILL_CATEGORY}' GROUP BY anio, trimestre",
    "olap_pivot": "SELECT nombre_categoria, "
    + ", ".join(
        f"CAST(coalesce(sum(subtotal) FILTER (trimestre = {q}), 0) AS DOUBLE) / 1000000 AS trimestre_{q}" for q in (1, 2, 3, 4)
    )
    + " FROM star GROUP BY nombre_categoria",
    "distinct_years": "SELECT DISTINCT anio FROM star",
    # --- KPIs and dashboard
    "kpi_totals": """
        SELECT CAST(sum(subtotal) AS DOUBLE) AS ventas_totales, count(DISTINCT id_orden) AS transacciones,
               count(DISTINCT id_producto) AS productos, min(anio) AS anio_min, max(anio) AS anio_max FROM star""",
    "kpi_yoy": """
        SELECT anio, ventas, ordenes, ventas / 1000000 AS ventas_mm, crecimiento_yoy_pct,
               CASE WHEN crecimiento_yoy_pct >= 5 THEN 'meta' WHEN crecimiento_yoy_pct > 0 THEN 'sube'
                    WHEN crecimiento_yoy_pct <= -5 THEN 'alerta' WHEN crecimiento_yoy_pct < 0 THEN 'baja'
                    ELSE 'neutro' END AS banda
        FROM anual""",
    "kpi_margin": """
        SELECT * REPLACE (round(margen_promedio, 6) AS margen_promedio),
               CASE WHEN margen_real_pct < 10 THEN 'critico' WHEN margen_real_pct < 25 THEN 'medio' ELSE 'meta' END AS banda
        FROM margen""",
    "kpi_summary": """
        SELECT (SELECT round_even(avg(crecimiento_yoy_pct), 4) FROM anual) AS crecimiento_medio_pct,
               round_even(avg(margen_real_pct), 4) AS margen_medio_pct,
               (SELECT nombre_categoria FROM margen ORDER BY margen_real_pct DESC, nombre_categoria LIMIT 1) AS mejor_categoria,
               max(margen_real_pct) AS mejor_margen_pct,
               (SELECT nombre_categoria FROM margen ORDER BY margen_real_pct, nombre_categoria LIMIT 1) AS peor_categoria,
               min(margen_real_pct) AS peor_margen_pct
        FROM margen""",
    "yoy_same_period": """
        WITH m AS (SELECT anio, mes, CAST(sum(subtotal) AS DOUBLE) AS ventas FROM star GROUP BY anio, mes)
        SELECT m.anio, m.mes, m.ventas, p.ventas AS ventas_previas,
               CASE WHEN p.ventas <> 0 THEN round((m.ventas - p.ventas) / p.ventas, 6) END AS crecimiento
        FROM m LEFT JOIN m p ON p.anio = m.anio - 1 AND p.mes = m.mes""",
    "bi_measures": """
        SELECT CAST(sum(subtotal) AS DOUBLE) AS total_ventas, count(DISTINCT id_orden) AS transacciones,
               (SELECT round(avg(margen_pct), 6) FROM dim_producto) AS margen_promedio FROM fact""",
    "dash_by_month": f"SELECT anio, mes, {_SALES}, count(*) AS lineas FROM star GROUP BY anio, mes",
    "dash_by_category": f"SELECT nombre_categoria, {_SALES}, count(*) AS lineas FROM star GROUP BY nombre_categoria",
    "dash_by_city": f"SELECT ciudad_tienda, {_SALES}, count(*) AS lineas FROM star GROUP BY ciudad_tienda",
    "dash_top_products": f"""
        SELECT id_producto, nombre_producto, {_SALES} FROM star GROUP BY 1, 2
        ORDER BY ventas DESC, id_producto, nombre_producto LIMIT 10""",
    # --- orders
    "orders_in_status": "SELECT * FROM v_orden WHERE estado IN ('Completada', 'Pendiente')",
    "orders_sorted": "SELECT id_orden, fecha_orden FROM v_orden ORDER BY fecha_orden DESC, id_orden",
    "lines_semi_orders": """
        SELECT id_detalle, id_orden, id_producto, cantidad, CAST(subtotal AS DOUBLE) AS subtotal FROM v_detalle
        WHERE id_orden IN (SELECT id_orden FROM v_orden WHERE estado = 'Completada')""",
    "promo_interval_join": "SELECT * FROM promo",
    "promo_one_per_order": """
        SELECT id_orden, id_promocion, valor FROM promo
        QUALIFY row_number() OVER (PARTITION BY id_orden ORDER BY md5(id_orden || '-' || id_promocion), id_promocion) = 1""",
    "delivery_dates": """
        SELECT *, fecha_estimada + to_days(CAST(retraso_dias AS INTEGER)) AS fecha_real FROM (
            SELECT *, fecha_orden + to_days(CAST(tiempo_entrega_dias AS INTEGER)) AS fecha_estimada FROM (
                SELECT id_orden, fecha_orden, id_orden % 9 + 1 AS tiempo_entrega_dias, id_orden % 7 - 2 AS retraso_dias
                FROM v_orden))""",
    # --- mining
    "rfm_scaled": """
        SELECT id_cliente, round((recency - avg(recency) OVER ()) / stddev_pop(recency) OVER (), 6) AS recency_z,
               round((frecuencia - avg(frecuencia) OVER ()) / stddev_pop(frecuencia) OVER (), 6) AS frecuencia_z,
               round((monto_total - avg(monto_total) OVER ()) / stddev_pop(monto_total) OVER (), 6) AS monto_total_z
        FROM dim_cliente""",
    "segment_inertia": f"""
        SELECT segmento_rfm, n AS clientes, round(inercia, 4) AS inercia FROM ({_inertia("escalado", "segmento_rfm")})""",
    "segment_silhouette": """
        SELECT g AS segmento_rfm, count(*) AS clientes, round(avg(s), 6) AS silueta FROM silueta_segmento GROUP BY g""",
    "segment_profile": """
        SELECT segmento_rfm AS cluster, count(*) AS clientes, round_even(avg(recency), 1) AS recency_media,
               round_even(avg(frecuencia), 1) AS frecuencia_media, round_even(avg(monto_total), 1) AS monto_total_media
        FROM dim_cliente GROUP BY segmento_rfm""",
    "band_elbow": "SELECT CAST(k AS INTEGER) AS k, inercia, silueta FROM codo_banda",
    "band_best_k": "SELECT CAST(k AS INTEGER) AS k, silueta FROM codo_banda ORDER BY silueta DESC, k LIMIT 1",
    "tree_predictions": """
        SELECT id_cliente, churn, CAST(prediccion AS INTEGER) AS prediccion, CAST(ruta[-1] AS INTEGER) AS hoja
        FROM camino JOIN arbol ON nodo = ruta[-1]""",
    "tree_nodes": "SELECT * REPLACE (round(gini, 6) AS gini) FROM nodos",
    "tree_importance": """
        SELECT f AS feature, round(coalesce(g / (SELECT sum(g) FROM ganancia), 0), 6) AS importancia
        FROM (VALUES ('recency'), ('frecuencia'), ('monto_total'), ('tasa_devolucion'), ('dias_desde_registro')) t(f)
             LEFT JOIN ganancia ON feature = f""",
    "tree_fold_accuracy": f"""
        SELECT fold, count(*) AS filas, round(avg(CASE WHEN churn = prediccion THEN 1.0 ELSE 0.0 END), 6) AS exactitud
        FROM (SELECT c.churn, a.prediccion, CAST((row_number() OVER (PARTITION BY c.churn
                       ORDER BY substr(md5(c.id_cliente || '-{P.SEED}'), 1, 8), c.id_cliente) - 1) % {P.FOLDS} AS INTEGER) AS fold
              FROM camino c JOIN arbol a ON a.nodo = c.ruta[-1]) GROUP BY fold""",
    "churn_label": "SELECT id_cliente, recency, CAST(recency > 180 AS INTEGER) AS churn FROM dim_cliente",
    "churn_rate": """
        SELECT count(*) AS clientes, count(*) FILTER (recency > 180) AS positivos,
               count(*) FILTER (recency <= 180) AS negativos,
               round(count(*) FILTER (recency > 180) / CAST(count(*) AS DOUBLE), 6) AS tasa FROM dim_cliente""",
    "churn_features": """
        SELECT c.id_cliente, c.recency, c.frecuencia, c.monto_total,
               round(coalesce(h.devueltas / CAST(nullif(h.lineas, 0) AS DOUBLE), 0), 6) AS tasa_devolucion,
               coalesce(h.dias, 0) AS dias_desde_registro, CAST(c.recency > 180 AS INTEGER) AS churn
        FROM dim_cliente c LEFT JOIN (
            SELECT o.id_cliente, count(d.id_orden) AS lineas, count(*) FILTER (d.devuelto) AS devueltas,
                   date_sub('day', min(o.fecha_orden), (SELECT max(fecha_orden) FROM v_orden)) AS dias
            FROM v_orden o LEFT JOIN v_detalle d USING (id_orden) GROUP BY o.id_cliente) h USING (id_cliente)""",
    "train_test_split": f"""
        SELECT id_cliente,
               CAST('0x' || substr(md5(id_cliente || '-{P.SEED}'), 1, 8) AS BIGINT) % 100 < 70 AS es_entrenamiento
        FROM dim_cliente""",
    "class_weights": f"""
        SELECT churn, count(*) AS filas, round(sum(count(*)) OVER () / CAST(count(*) OVER () * count(*) AS DOUBLE), 6) AS peso
        FROM (SELECT CAST(recency > 180 AS INTEGER) AS churn FROM dim_cliente
              WHERE CAST('0x' || substr(md5(id_cliente || '-{P.SEED}'), 1, 8) AS BIGINT) % 100 < 70)
        GROUP BY churn""",
    "stratified_folds": f"""
        SELECT id_cliente, churn,
               CAST((row_number() OVER (PARTITION BY churn ORDER BY h, id_cliente) - 1) % {P.FOLDS} AS INTEGER) AS fold
        FROM (SELECT id_cliente, CAST(recency > 180 AS INTEGER) AS churn, substr(md5(id_cliente || '-{P.SEED}'), 1, 8) AS h
              FROM dim_cliente)""",
    "confusion_matrix": """
        SELECT r.v AS real, q.v AS predicho, (SELECT count(*) FROM regla_fija WHERE y = r.v AND p = q.v) AS n
        FROM (VALUES (0), (1)) AS r(v), (VALUES (0), (1)) AS q(v)""",
    "classification_metrics": """
        SELECT CAST(c AS VARCHAR) AS clase, round(pre, 6) AS precision, round(rec, 6) AS recall, round(f, 6) AS f1,
               re AS soporte FROM por_clase_f
        UNION ALL
        SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n
        FROM (SELECT sum(tp) / CAST(sum(re) AS DOUBLE) AS a, CAST(sum(re) AS BIGINT) AS n FROM por_clase_f)
        UNION ALL
        SELECT 'macro avg', round(avg(pre), 6), round(avg(rec), 6), round(avg(f), 6), CAST(sum(re) AS BIGINT) FROM por_clase_f
        UNION ALL
        SELECT 'weighted avg', round(sum(pre * re) / sum(re), 6), round(sum(rec * re) / sum(re), 6),
               round(sum(f * re) / sum(re), 6), CAST(sum(re) AS BIGINT) FROM por_clase_f""",
    "product_profile": "SELECT * REPLACE (round(precio_promedio, 6) AS precio_promedio) FROM perfil",
    "price_band": "SELECT id_producto, round(precio_promedio, 6) AS precio_promedio, CASE "
    + " ".join(
        f"WHEN precio_promedio > {lo} AND precio_promedio <= {hi} THEN '{name}'"
        for lo, hi, name in zip(P.PRICE_EDGES[:-1], P.PRICE_EDGES[1:], P.PRICE_LABELS, strict=True)
    )
    + " END AS rango_precio FROM perfil",
    "return_risk_score": "SELECT id_producto, nombre_categoria, prob_devolucion FROM riesgo",
    "return_label": """
        SELECT id_producto, lineas, lineas_devueltas, CAST(3 * lineas_devueltas > lineas AS INTEGER) AS devuelto FROM perfil""",
    "return_rate_category": """
        SELECT nombre_categoria, round_even(avg(CAST(3 * lineas_devueltas > lineas AS INTEGER)) * 100, 1) AS prob_real_pct,
               round(avg(precio_promedio), 6) AS precio_promedio FROM perfil GROUP BY nombre_categoria""",
    "label_encode": """
        SELECT id_producto, nombre_categoria, dense_rank() OVER (ORDER BY nombre_categoria) - 1 AS categoria_cod
        FROM dim_producto""",
    "naive_bayes_fit": """
        SELECT clase, n, round(prior, 4) AS prior, feature, round(media, 4) AS media, round(varianza, 4) AS varianza
        FROM modelo""",
    "naive_bayes_predict": """
        SELECT id_producto, riesgo, CAST(arg_min(clase, (-ll, clase)) AS INTEGER) AS prediccion,
               round(1 / sum(exp(ll - top)), 6) AS probabilidad
        FROM (SELECT *, max(ll) OVER (PARTITION BY id_producto) AS top FROM puntaje) GROUP BY id_producto, riesgo""",
    "naive_bayes_accuracy": "SELECT n, round(exactitud, 6) AS exactitud FROM ronda_exactitud WHERE r = -1",
    "naive_bayes_cv": """
        SELECT CAST(count(*) AS INTEGER) AS folds, round(avg(exactitud), 6) AS exactitud_media
        FROM ronda_exactitud WHERE r >= 0""",
    "weekly_sales": "SELECT i, semana_fin, ventas, transacciones FROM semanal",
    "seasonal_decompose": _decompose("semanal"),
    "seasonal_by_category": _decompose("semanal_categoria", "nombre_categoria"),
    "monthly_category_matrix": """
        SELECT anio, mes, round(max(ventas) FILTER (columna = 'total_ventas'), 4) AS total_ventas,
               {types} FROM celdas GROUP BY anio, mes""".replace(
        "{types}",
        ", ".join(
            f"max(ventas) FILTER (columna = '{c}') AS {c}"
            for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        ),
    ),
    "category_correlation": "SELECT a, b, round(correlacion, 6) AS correlacion FROM correlaciones",
    "top_correlations": """
        SELECT CASE WHEN a = 'total_ventas' THEN b ELSE a END AS columna, round(correlacion, 6) AS correlacion
        FROM correlaciones WHERE (a = 'total_ventas' OR b = 'total_ventas') AND a <> b
        ORDER BY correlaciones.correlacion DESC, columna LIMIT 5""",
    "basket_items": "SELECT DISTINCT id_orden, id_producto FROM v_detalle",
    "basket_sample": f"""
        SELECT id_orden FROM (SELECT DISTINCT id_orden FROM v_detalle)
        ORDER BY md5(id_orden || '-{P.SEED}'), id_orden LIMIT {P.SAMPLE}""",
    "baskets": """
        SELECT o AS id_orden, CAST(count(*) AS INTEGER) AS num_items, string_agg(x, ', ' ORDER BY x) AS items
        FROM pares GROUP BY o""",
    "frequent_itemsets": """
        SELECT array_to_string(s, ', ') AS items, CAST(len(s) AS INTEGER) AS num_items, c AS frecuencia,
               round(soporte, 6) AS soporte FROM conjuntos""",
    "top_itemsets": """
        SELECT array_to_string(s, ', ') AS etiqueta, CAST(len(s) AS INTEGER) AS num_items, c AS frecuencia,
               round(soporte, 6) AS soporte FROM conjuntos ORDER BY frecuencia DESC, etiqueta LIMIT 10""",
    "association_rules": """
        SELECT array_to_string(a, ', ') AS antecedente, array_to_string(k, ', ') AS consecuente,
               round(soporte_a, 6) AS soporte_a, round(soporte_c, 6) AS soporte_c, round(soporte, 6) AS soporte,
               round(confianza, 6) AS confianza, round(lift, 6) AS lift,
               round(soporte - soporte_a * soporte_c, 6) AS leverage,
               CASE WHEN confianza >= 1 THEN CAST('inf' AS DOUBLE) ELSE round((1 - soporte_c) / (1 - confianza), 6) END
                   AS conviccion
        FROM reglas""",
    "top_rules": """
        SELECT array_to_string(a, ', ') AS antecedente, array_to_string(k, ', ') AS consecuente,
               round(soporte, 6) AS soporte, round(confianza, 6) AS confianza, round(lift, 6) AS lift
        FROM reglas ORDER BY round(reglas.lift, 9) DESC, reglas.soporte DESC, antecedente, consecuente LIMIT 5""",
}
SQL["itemset_chart_labels"] = f"""
        SELECT array_to_string(s[1:{P.CHART_ITEMS}], ', ') AS etiqueta, CAST(len(s) AS INTEGER) AS num_items, c AS frecuencia,
               round(soporte, 6) AS soporte
        FROM conjuntos ORDER BY c DESC, array_to_string(s, ', ') LIMIT {P.CHART_SETS}"""
SQL["frequent_itemsets_category"] = SQL["frequent_itemsets"]
SQL["association_rules_brand"] = SQL["association_rules"]

_HISTORIES = {
    "Dim_Producto_SCD": "scd2_product",
    "Dim_Cliente_SCD": "scd2_customer",
    "Dim_Tienda_SCD": "dim_store_scd1",
    "Dim_Empleado_SCD": "dim_employee_scd1",
    "Dim_MetodoPago_SCD": "dim_payment_scd1",
    **{f"Cubo_Ventas_N{n}": f"cube_n{n}" for n in range(5)},
}
_stored = " UNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM ({SQL[k]})" for t, k in _HISTORIES.items())
SQL["load_warehouse"] = f"""
        WITH n AS (SELECT * FROM manifiesto UNION ALL {_stored})
        SELECT * FROM n UNION ALL SELECT 'TOTAL', CAST(sum(filas) AS BIGINT) FROM n"""
_scd1 = {
    "Dim_Tienda_SCD": "id_tienda nombre_tienda nombre_ciudad region zona tipo tamano_m2 ultima_actualizacion",
    "Dim_Empleado_SCD": "id_empleado nombre_empleado cargo nombre_tienda fecha_contratacion salario ultima_actualizacion",
    "Dim_MetodoPago_SCD": "id_metodo_pago nombre comision_pct ultima_actualizacion",
}
_scd1_columns = ", ".join(
    f"('{t}', {i}, '{c}', {str(i == 1).upper()})" for t, cols in _scd1.items() for i, c in enumerate(cols.split(), 1)
)
SQL["warehouse_listing"] = f"""
        SELECT c.*, n.filas FROM (VALUES {_scd1_columns}) AS c(tabla, posicion, columna, es_pk)
             JOIN ({_stored}) n USING (tabla)"""
SQL["stored_star_pivot"] = SQL["olap_pivot"]
SQL["files_star_pivot"] = SQL["olap_pivot"].replace(
    " FROM star",
    """ FROM (SELECT s.* REPLACE (round_even(s.precio_unitario * CAST(s.cantidad AS DOUBLE) * (1 - s.descuento), 0) AS subtotal) FROM star s)""",
)
SQL["files_return_rate"] = """
        SELECT t.id_tienda, count(*) AS lineas, count(r.id_orden) AS devueltas,
               CAST(sum(CAST(round_even(d.precio_unitario * CAST(d.cantidad AS DOUBLE) * (1 - d.descuento), 0) AS BIGINT)) AS BIGINT) AS ventas
        FROM v_detalle d JOIN (SELECT id_orden, min(id_tienda) AS id_tienda FROM v_detalle GROUP BY id_orden) t USING (id_orden)
             LEFT JOIN (SELECT DISTINCT id_orden, id_producto FROM v_detalle WHERE devuelto) r USING (id_orden, id_producto)
        GROUP BY t.id_tienda"""
SQL["stored_star_join"] = """
        SELECT id_detalle, id_orden, id_producto, id_cliente, id_tienda, anio, mes, trimestre, nombre_categoria, margen_pct,
               tipo_tienda, ciudad_tienda, zona_tienda, cantidad, CAST(subtotal AS DOUBLE) AS subtotal FROM star"""
_keys = {
    "Dim_Tiempo": ("dim_tiempo", "id_tiempo"),
    "Dim_Producto": ("dim_producto", "id_producto"),
    "Dim_Tienda": ("dim_tienda", "id_tienda"),
    "Dim_Empleado": ("dim_empleado_inner", "id_empleado"),
    "Dim_MetodoPago": ("v_metodo_pago", "id_metodo_pago"),
    "Fact_Ventas": ("fact", "id_detalle"),
}
SQL["load_metrics"] = " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, count(*) AS filas, count(*) FILTER ({key} IS NULL) AS claves_nulas, "
    f"CAST({'sum(subtotal)' if t == 'Fact_Ventas' else 'NULL'} AS DOUBLE) AS importe FROM {view}"
    for t, (view, key) in _keys.items()
)
# The columns of the listed tables, in order.
_catalog = {
    "dim_tiempo": (
        "id_tiempo fecha anio mes nombre_mes trimestre semana dia_semana nombre_dia es_fin_semana estacion fecha_date", "dim_tiempo"
    ),
    "dim_tienda": ("id_tienda nombre_tienda id_ciudad tipo tamano_m2 nombre_ciudad region zona", "dim_tienda"),
    "dim_metodopago": ("id_metodo_pago nombre comision_pct", "v_metodo_pago"),
}
SQL["catalog_listing"] = " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, CAST({i} AS INTEGER) AS posicion, '{c}' AS columna, CAST({_value(P.COLUMN_NOTES.get(c))} AS VARCHAR) AS comentario, "
    f"{i == 1} AS es_pk, (SELECT count(*) FROM {view}) AS filas"
    for t, (columns, view) in _catalog.items()
    for i, c in enumerate(columns.split(), 1)
)

_ITEMS = {
    "baskets": BRANDS,
    "frequent_itemsets": BRANDS,
    "top_itemsets": BRANDS,
    "association_rules_brand": BRANDS,
    "frequent_itemsets_category": TYPES,
    "itemset_chart_labels": TYPES,
    "association_rules": TYPES,
    "top_rules": TYPES,
}


def _needed(sql: str, views: dict[str, str], found: list[str]) -> list[str]:
    """Names of the views a statement uses, each after the ones it depends on."""
    for name in views:
        if name not in found and re.search(rf"(?i)\b(FROM|JOIN|bayes ON|UNPIVOT|,)\s+{name}\b", sql):
            _needed(views[name], views, found)
            if name not in found:
                found.append(name)
    return found


def statement(key: str) -> str:
    sql = SQL[key].strip()
    views = {**VIEWS, **_ITEMS.get(key, {})}
    names = _needed(sql, views, [])
    if not names:
        return sql
    heads = ", ".join(f"{n} AS ({views[n].strip()})" for n in names)
    if sql.upper().startswith("WITH "):
        return f"WITH {heads}, {sql[5:].strip()}"
    return f"WITH {heads} {sql}"


def oracle_sql() -> dict[str, str]:
    return {key: statement(key) for key in SQL}
