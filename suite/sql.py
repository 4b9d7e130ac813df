"""SQL counterparts of the views in ``suite.tables``, as common table expressions."""

from __future__ import annotations

CTES = {
    "newest": ((), """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
    l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
    l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1"""),
    "priced": (("newest",), """
SELECT n.*, p_type AS categoria_id, p_size, CAST(p_retailprice AS DECIMAL(9,2)) AS precio,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS bruto, CAST(l_quantity AS BIGINT) AS cantidad,
  CAST(l_discount AS DECIMAL(4,2)) AS dto, CAST(l_tax AS DECIMAL(4,2)) AS tasa
FROM newest n JOIN part ON l_partkey = p_partkey"""),
    "discounted": (("priced",), "SELECT *, CAST(bruto * dto AS DECIMAL(18,2)) AS descuento_valor FROM priced"),
    "based": (("discounted",),
              "SELECT *, CAST(bruto - descuento_valor AS DECIMAL(18,2)) AS base_sin_iva FROM discounted"),
    "taxed": (("based",), """
SELECT *, CAST(base_sin_iva * tasa AS DECIMAL(18,2)) AS iva_valor,
  CAST(CAST(cantidad AS DECIMAL(8,0)) * precio AS DECIMAL(18,2)) AS costo_total_linea FROM based"""),
    "lines": (("taxed",), """
SELECT *, CAST(base_sin_iva + iva_valor AS DECIMAL(18,2)) AS valor_total_linea,
  CAST(base_sin_iva - costo_total_linea AS DECIMAL(18,2)) AS margen_bruto_linea,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS detalle_venta_id,
  CAST(l_partkey AS VARCHAR) AS producto_id, CAST(l_suppkey AS VARCHAR) AS proveedor_id,
  strftime(l_shipdate, '%Y-%m') AS mes_envio, CAST(l_shipdate AS DATE) AS fecha_envio FROM taxed"""),
    "sold": ((), """
SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_total, o_orderdate,
  CAST(o_orderkey AS VARCHAR) AS venta_id, CAST(o_custkey AS VARCHAR) AS cliente_id, c_mktsegment AS tienda_id,
  CAST(c_nationkey AS VARCHAR) AS ciudad_id, o_orderpriority AS canal_id,
  strftime(o_orderdate, '%Y-%m') AS mes_carga, CAST(o_orderdate AS DATE) AS fecha_venta
FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "placed": (("lines", "sold"), "SELECT * FROM lines JOIN sold ON l_orderkey = o_orderkey"),
    "header": (("lines", "sold"), """
SELECT venta_id, CAST(strftime(fecha_venta, '%Y%m%d') AS BIGINT) AS fecha_id, fecha_venta, mes_carga, tienda_id,
  ciudad_id, cliente_id, canal_id, nullif(o_orderstatus, 'O') AS campana_id, valor_bruto, descuento_total,
  iva_total, valor_total, costo_total, margen_bruto, numero_lineas, valor_bruto - descuento_total AS base_neta_sin_iva
FROM (SELECT l_orderkey, sum(bruto) AS valor_bruto, sum(descuento_valor) AS descuento_total,
        sum(iva_valor) AS iva_total, sum(valor_total_linea) AS valor_total, sum(costo_total_linea) AS costo_total,
        sum(margen_bruto_linea) AS margen_bruto, count(*) AS numero_lineas FROM lines GROUP BY 1)
JOIN sold ON l_orderkey = o_orderkey"""),
    "back": (("placed",), """
SELECT 'D' || detalle_venta_id AS devolucion_id, venta_id, detalle_venta_id, mes_envio AS mes_carga, tienda_id,
  ciudad_id, categoria_id, producto_id, l_linestatus AS motivo_devolucion_id, fecha_envio AS fecha_devolucion,
  CASE WHEN l_linestatus = 'F' THEN 'Aprobada' WHEN l_tax = 0 THEN 'Rechazada' ELSE 'En revision' END AS estado_devolucion,
  cantidad AS cantidad_devuelta, valor_total_linea AS valor_reintegrado,
  l_linestatus = 'F' AS requiere_revision_calidad,
  date_diff('day', fecha_venta, fecha_envio) AS dias_hasta_devolucion
FROM placed WHERE l_returnflag = 'R'"""),
    "bought": (("placed",), """
SELECT detalle_venta_id AS orden_compra_id, mes_envio AS mes_carga, tienda_id, producto_id, proveedor_id,
  categoria_id, l_returnflag AS motivo_compra,
  CASE WHEN l_linestatus = 'F' THEN 'Recibida' WHEN l_returnflag = 'R' THEN 'Parcial' ELSE 'Pendiente' END AS estado_orden,
  cantidad AS cantidad_comprada, base_sin_iva AS subtotal_sin_iva, iva_valor, valor_total_linea AS valor_total_compra
FROM placed"""),
    "shipped0": (("placed",), """
SELECT 'E' || detalle_venta_id AS entrega_id, venta_id, mes_carga, tienda_id,
  CAST(s_nationkey AS VARCHAR) AS ciudad_origen_id, ciudad_id AS ciudad_destino_id, canal_id,
  CAST(l_suppkey % 5 AS VARCHAR) AS transportista_id,
  CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey % 50 AS VARCHAR) END AS empleado_repartidor_id,
  CASE WHEN l_linestatus = 'F' THEN fecha_envio END AS fecha_entrega,
  CAST(substr(canal_id, 1, 1) AS BIGINT) * 30 AS dias_prometidos,
  CASE WHEN l_linestatus = 'F' THEN date_diff('day', fecha_venta, fecha_envio) END AS dias_reales_entrega,
  l_returnflag = 'R' AS vuelta, l_quantity AS peso_estimado_kg,
  CAST(CAST(cantidad AS DECIMAL(8,0)) * CAST(0.50 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS costo_envio
FROM placed JOIN supplier ON l_suppkey = s_suppkey"""),
    "shipped": (("shipped0",), """
SELECT * EXCLUDE (vuelta), dias_reales_entrega - dias_prometidos AS dias_retraso,
  CASE WHEN vuelta AND fecha_entrega IS NULL THEN 'Cancelado en ruta' WHEN vuelta THEN 'Intento fallido'
       WHEN dias_reales_entrega > dias_prometidos THEN 'Entregado tarde'
       WHEN fecha_entrega IS NOT NULL THEN 'Entregado' END AS estado_entrega FROM shipped0"""),
    "delivered": (("shipped",), """
SELECT *, estado_entrega = 'Entregado' AND fecha_entrega IS NOT NULL AND dias_retraso <= 0 AS entrega_a_tiempo,
  estado_entrega = 'Entregado tarde' OR (fecha_entrega IS NOT NULL AND dias_retraso > 0) AS entrega_tardia,
  estado_entrega = 'Intento fallido' AS entrega_fallida, estado_entrega = 'Cancelado en ruta' AS entrega_cancelada,
  fecha_entrega IS NULL AS entrega_pendiente,
  CASE WHEN empleado_repartidor_id IS NOT NULL THEN 'Interna' ELSE 'Tercero' END AS tipo_entrega_operativa,
  CAST(costo_envio AS DOUBLE) / nullif(peso_estimado_kg, 0) AS costo_por_kg FROM shipped"""),
    "stock0": (("placed",), """
SELECT mes_envio AS mes_carga, tienda_id, producto_id, categoria_id, p_size, precio,
  CAST(coalesce(sum(cantidad) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS entradas_compras,
  CAST(coalesce(sum(cantidad) FILTER (l_returnflag <> 'R'), 0) AS BIGINT) AS salidas_ventas,
  count(*) FILTER (l_discount = 0) AS ajuste_unidades, count(*) FILTER (l_tax = 0) AS merma_unidades
FROM placed GROUP BY ALL"""),
    "stock1": (("stock0",), """
SELECT *, CAST(p_size * 10 AS BIGINT) AS stock_inicial,
  CAST(p_size * 10 AS BIGINT) + entradas_compras - salidas_ventas + ajuste_unidades - merma_unidades AS stock_final,
  CAST(p_size * 9 AS BIGINT) AS punto_reorden, CAST(p_size * 8 AS BIGINT) AS stock_seguridad,
  CAST(p_size AS BIGINT) AS cobertura_dias FROM stock0"""),
    "stock": (("stock1",), """
SELECT * EXCLUDE (p_size, precio), CAST(CAST(stock_final AS DECIMAL(9,0)) * precio AS DECIMAL(18,2)) AS valor_inventario_costo,
  CAST(stock_inicial + stock_final AS DOUBLE) / 2 AS stock_promedio, stock_final <= punto_reorden AS alerta_reorden,
  stock_final <= stock_seguridad AS alerta_stock_seguridad,
  CAST(salidas_ventas AS DOUBLE) / nullif(CAST(stock_inicial + stock_final AS DOUBLE) / 2, 0) AS rotacion_estimada
FROM stock1"""),
    "promoted0": ((), """
SELECT CAST(ts AS DATE) - INTERVAL 300 MONTH AS dia, user_id % 8 AS grupo,
  coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'error'), 0) AS gasto_marketing,
  count(*) FILTER (event_type = 'view') AS impresiones, count(*) FILTER (event_type = 'click') AS clics,
  count(*) FILTER (event_type = 'signup') AS leads, count(*) FILTER (event_type = 'purchase') AS conversiones_atribuidas,
  coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase'), 0) AS ventas_atribuidas_valor
FROM events GROUP BY 1, 2"""),
    "promoted": (("promoted0",), """
SELECT strftime(dia, '%Y%m%d') || '-' || CAST(grupo AS VARCHAR) AS marketing_id, strftime(dia, '%Y-%m') AS mes_carga,
  CASE grupo % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'P' ELSE 'X' END AS campana_id, CAST(grupo AS VARCHAR) AS ciudad_id,
  CASE WHEN grupo < 4 THEN '1-URGENT' ELSE '5-LOW' END AS canal_id,
  CASE WHEN grupo % 2 = 0 THEN 'Digital' ELSE 'Tradicional' END AS medio_principal,
  gasto_marketing, impresiones, clics, leads, conversiones_atribuidas, ventas_atribuidas_valor FROM promoted0"""),
    "spent": (("placed",), """
SELECT mes_envio AS mes_carga, tienda_id, sum(base_sin_iva) AS monto_presupuestado, sum(costo_total_linea) AS monto_real,
  mes_envio || '-' || tienda_id AS costo_id FROM placed GROUP BY ALL"""),
    "planned": (("sold",), """
SELECT mes_carga, tienda_id, sum(o_total) AS monto_presupuesto, sum(o_total) FILTER (o_orderstatus = 'F') AS monto_ejecutado,
  mes_carga || '-' || tienda_id AS presupuesto_id FROM sold GROUP BY ALL"""),
    "goals": (("sold",), """
SELECT mes_carga, tienda_id, CAST(CAST(sum(o_total) AS DECIMAL(18,2)) * CAST(0.95 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS meta_ventas,
  count(*) - 1 AS meta_tickets,
  CAST(CAST(sum(o_total) AS DECIMAL(18,2)) * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS meta_margen_bruto,
  CAST(0.25 AS DOUBLE) AS meta_tasa_devolucion, count(*) * 3 AS meta_entregas FROM sold GROUP BY ALL"""),
    "control": (("sold",), """
SELECT mes_carga, count(*) AS ventas, sum(o_total) AS valor_total, sum(o_total) FILTER (o_orderstatus = 'P') AS margen_bruto,
  count(*) FILTER (o_orderstatus = 'F') AS devoluciones, sum(o_total) FILTER (o_orderstatus = 'F') AS valor_reintegrado
FROM sold GROUP BY ALL"""),
    "city": ((), """
SELECT CAST(n_nationkey AS VARCHAR) AS ciudad_id, n_name AS ciudad_nombre,
  'Depto ' || CAST(n_regionkey AS VARCHAR) AS ciudad_departamento, r_name AS ciudad_region
FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "store": (("city",), """
SELECT tienda_id, upper(tienda_id[1]) || lower(tienda_id[2:]) AS tienda_nombre, 'Sede' AS tienda_tipo_sede,
  'Activa' AS tienda_estado_sede, ciudad_nombre AS tienda_ciudad_nombre,
  ciudad_departamento AS tienda_departamento, ciudad_region AS tienda_region
FROM (SELECT c_mktsegment AS tienda_id, CAST(min(c_nationkey) AS VARCHAR) AS ciudad_id FROM customer GROUP BY 1)
LEFT JOIN city USING (ciudad_id)"""),
    "channel": ((), """
SELECT DISTINCT o_orderpriority AS canal_id, substr(o_orderpriority, 3) AS canal_nombre,
  substr(o_orderpriority, 1, 1) AS canal_tipo, lower(o_orderpriority) AS canal_descripcion FROM orders"""),
    "product": ((), """
SELECT CAST(p_partkey AS VARCHAR) AS producto_id, 'SKU' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS producto_nombre,
  p_brand AS producto_marca, p_type AS producto_especie, 'und' AS producto_unidad_medida,
  CASE WHEN p_size > 25 THEN 'Alta' ELSE 'Baja' END AS producto_nivel_rotacion FROM part"""),
    "category": ((), """
SELECT p_type AS categoria_id, upper(p_type[1]) || lower(p_type[2:]) AS categoria_producto, 'Familia' AS categoria_familia,
  min(p_brand) AS categoria_especie_principal, max(p_brand) AS categoria_descripcion FROM part GROUP BY p_type"""),
    "vendor": ((), """
SELECT CAST(s_suppkey AS VARCHAR) AS proveedor_id, s_name AS proveedor_nombre,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Local' ELSE 'Externo' END AS tipo_proveedor,
  'Linea ' || CAST(s_suppkey % 7 AS VARCHAR) AS especialidad, 'Activo' AS estado_proveedor,
  s_suppkey % 10 + 5 AS lead_time_promedio_dias, CAST(s_suppkey % 5 AS DOUBLE) AS calificacion_servicio FROM supplier"""),
    "terms": (("lines",), """
SELECT producto_id, proveedor_id, min(bruto) AS costo_negociado, nullif(CAST(min(l_linenumber) * 3 AS BIGINT), 3) AS lead_time_dias
FROM lines WHERE l_suppkey % 2 = 0 GROUP BY 1, 2"""),
    "carrier": ((), """
SELECT DISTINCT CAST(s_suppkey % 5 AS VARCHAR) AS transportista_id,
  'Carrier ' || CAST(s_suppkey % 5 AS VARCHAR) AS transportista_nombre, 'Terrestre' AS tipo_transportista,
  'Nacional' AS cobertura FROM supplier"""),
    "reason": ((), """
SELECT DISTINCT l_linestatus AS motivo_devolucion_id, 'Motivo ' || l_linestatus AS motivo_devolucion,
  'Tienda' AS responsable_principal, 'Media' AS severidad FROM lineitem"""),
    "campaign": ((), """
SELECT DISTINCT o_orderstatus AS campana_id, 'Campana ' || o_orderstatus AS campana_nombre, 'Digital' AS tipo_campana,
  'todas' AS categorias_objetivo, 'todos' AS canales_objetivo FROM orders"""),
}


def define(name: str, needs: tuple[str, ...], body: str) -> None:
    """Add a named expression for other statements to build on."""
    CTES[name] = (needs, body)


def sql(body: str, *needs: str) -> str:
    """A statement with the expressions it needs, in order of dependence."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for d in CTES[name][0]:
            visit(d)
        ordered.append(name)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body


def share(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0)"


def dbl(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def whole(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"
