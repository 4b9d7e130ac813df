"""Gold products, KPIs and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import query
from suite.sql import dbl, define, share, sql, whole
from suite.tables import base_lake, silver_lake
from tidemark import fixed_values as fv
from tidemark.plans import dims, gold, marts
from tidemark.plans.bronze import PARTITIONS
from tidemark.plans.reconcile import gold_checks
from tidemark.plans.settings import Settings
from tidemark.sources.tables import LakeTable
from tidemark.workspace import new_folder


def ratios(**pairs: tuple[str, str]) -> str:
    return ", ".join(f"{share(a, b)} AS {name}" for name, (a, b) in pairs.items())


# --- mart cores as SQL: exact decimals, ratios added by the outer statement ------------

define("m_sales", ("header",), """
SELECT mes_carga, tienda_id, ciudad_id, canal_id, sum(valor_bruto) AS ventas_brutas, sum(descuento_total) AS descuentos,
  sum(iva_total) AS iva, sum(base_neta_sin_iva) AS ventas_sin_iva, sum(valor_total) AS ventas_totales,
  sum(costo_total) AS costo_total, sum(margen_bruto) AS margen_bruto, count(DISTINCT venta_id) AS numero_ventas,
  CAST(sum(numero_lineas) AS BIGINT) AS numero_lineas,
  count(DISTINCT CASE WHEN campana_id IS NOT NULL THEN venta_id END) AS ventas_con_campana
FROM header GROUP BY ALL""")
define("m_product", ("placed",), """
SELECT mes_carga, tienda_id, ciudad_id, canal_id, categoria_id, producto_id, count(DISTINCT venta_id) AS numero_ventas,
  count(DISTINCT detalle_venta_id) AS lineas_vendidas, CAST(sum(cantidad) AS BIGINT) AS unidades_vendidas,
  sum(base_sin_iva) AS ventas_linea_sin_iva, sum(valor_total_linea) AS ventas_linea_con_iva,
  sum(costo_total_linea) AS costo_total_linea, sum(margen_bruto_linea) AS margen_bruto_linea
FROM placed GROUP BY ALL""")
define("m_returns", ("back",), """
SELECT mes_carga, tienda_id, ciudad_id, categoria_id, producto_id, motivo_devolucion_id,
  count(DISTINCT devolucion_id) AS devoluciones, CAST(sum(cantidad_devuelta) AS BIGINT) AS unidades_devueltas,
  sum(valor_reintegrado) AS valor_reintegrado, count(DISTINCT venta_id) AS ventas_con_devolucion,
  count(DISTINCT detalle_venta_id) AS lineas_con_devolucion,
  CAST(sum(CASE WHEN requiere_revision_calidad THEN 1 ELSE 0 END) AS BIGINT) AS devoluciones_revision_calidad,
  CAST(sum(dias_hasta_devolucion) AS DOUBLE) / nullif(count(dias_hasta_devolucion), 0) AS dias_promedio_hasta_devolucion
FROM back GROUP BY ALL""")
define("m_marketing", ("promoted",), """
SELECT mes_carga, campana_id, ciudad_id, canal_id, medio_principal, sum(gasto_marketing) AS gasto_marketing,
  CAST(sum(impresiones) AS BIGINT) AS impresiones, CAST(sum(clics) AS BIGINT) AS clics, CAST(sum(leads) AS BIGINT) AS leads,
  CAST(sum(conversiones_atribuidas) AS BIGINT) AS conversiones_atribuidas, sum(ventas_atribuidas_valor) AS ventas_atribuidas_valor
FROM promoted GROUP BY ALL""")
define("m_inventory", ("stock",), """
SELECT mes_carga, tienda_id, producto_id, categoria_id, CAST(sum(stock_inicial) AS BIGINT) AS stock_inicial,
  CAST(sum(entradas_compras) AS BIGINT) AS entradas_compras, CAST(sum(salidas_ventas) AS BIGINT) AS salidas_ventas,
  CAST(sum(ajuste_unidades) AS BIGINT) AS ajuste_unidades, CAST(sum(merma_unidades) AS BIGINT) AS merma_unidades,
  CAST(sum(stock_final) AS BIGINT) AS stock_final, sum(valor_inventario_costo) AS valor_inventario_costo,
  CAST(sum(cobertura_dias) AS DOUBLE) / nullif(count(cobertura_dias), 0) AS cobertura_dias_promedio,
  CAST(sum(CASE WHEN alerta_reorden THEN 1 ELSE 0 END) AS BIGINT) AS productos_bajo_reorden,
  CAST(sum(CASE WHEN alerta_stock_seguridad THEN 1 ELSE 0 END) AS BIGINT) AS productos_bajo_stock_seguridad,
  CAST(sum(CASE WHEN stock_final <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS stockout_count,
  sum(stock_promedio) / nullif(count(stock_promedio), 0) AS stock_promedio
FROM stock GROUP BY ALL""")
define("m_logistics", ("delivered",), """
SELECT mes_carga, tienda_id, ciudad_origen_id, ciudad_destino_id, canal_id, transportista_id,
  count(DISTINCT entrega_id) AS entregas, count(*) FILTER (entrega_a_tiempo) AS entregas_a_tiempo,
  count(*) FILTER (entrega_tardia) AS entregas_tardias, count(*) FILTER (entrega_fallida) AS entregas_fallidas,
  count(*) FILTER (entrega_cancelada) AS entregas_canceladas, count(*) FILTER (entrega_pendiente) AS entregas_pendientes,
  CAST(sum(dias_prometidos) AS DOUBLE) / nullif(count(dias_prometidos), 0) AS dias_prometidos_promedio,
  CAST(sum(dias_reales_entrega) AS DOUBLE) / nullif(count(dias_reales_entrega), 0) AS dias_reales_promedio,
  CAST(sum(dias_retraso) AS DOUBLE) / nullif(count(dias_retraso), 0) AS dias_retraso_promedio,
  sum(peso_estimado_kg) AS peso_total_kg, sum(costo_envio) AS costo_envio_total
FROM delivered GROUP BY ALL""")
define("sales_store", ("header",), """
SELECT mes_carga, tienda_id, sum(valor_total) AS ventas_totales, sum(base_neta_sin_iva) AS ventas_sin_iva,
  sum(margen_bruto) AS margen_bruto, count(DISTINCT venta_id) AS numero_ventas FROM header GROUP BY ALL""")
define("m_finance", ("planned", "spent", "sales_store"), """
SELECT coalesce(p.mes_carga, s.mes_carga) AS mes_carga, coalesce(p.tienda_id, s.tienda_id) AS tienda_id,
  monto_presupuesto AS presupuesto, monto_ejecutado AS ejecutado, monto_presupuestado AS costos_presupuestados,
  monto_real AS costos_reales, ventas_totales, ventas_sin_iva, margen_bruto, numero_ventas
FROM planned p FULL JOIN spent s ON p.mes_carga = s.mes_carga AND p.tienda_id = s.tienda_id
LEFT JOIN sales_store v ON v.mes_carga = coalesce(p.mes_carga, s.mes_carga) AND v.tienda_id = coalesce(p.tienda_id, s.tienda_id)""")
define("m_targets", ("goals", "sales_store", "back", "delivered"), """
SELECT g.mes_carga, g.tienda_id, meta_ventas, meta_tickets, meta_margen_bruto, meta_tasa_devolucion, meta_entregas,
  ventas_totales, ventas_sin_iva, margen_bruto, numero_ventas, devoluciones, entregas
FROM goals g LEFT JOIN sales_store v USING (mes_carga, tienda_id)
LEFT JOIN (SELECT mes_carga, tienda_id, count(DISTINCT devolucion_id) AS devoluciones FROM back GROUP BY ALL) USING (mes_carga, tienda_id)
LEFT JOIN (SELECT mes_carga, tienda_id, count(DISTINCT entrega_id) AS entregas FROM delivered GROUP BY ALL) USING (mes_carga, tienda_id)""")


@query("dim_store_city", sql("SELECT * FROM store", "store"))
def dim_store_city(spark, sf):
    return dims.store(base_lake(spark, sf))


@query("mart_sales", sql(f"""
SELECT mes_carga, m.tienda_id, m.ciudad_id, m.canal_id,
  {dbl('ventas_brutas', 'descuentos', 'iva', 'ventas_sin_iva', 'ventas_totales', 'costo_total', 'margen_bruto')},
  numero_ventas, numero_lineas, ventas_con_campana,
  {ratios(margen_bruto_pct=('margen_bruto', 'ventas_sin_iva'), ticket_promedio=('ventas_totales', 'numero_ventas'),
          ticket_promedio_sin_iva=('ventas_sin_iva', 'numero_ventas'),
          lineas_promedio_por_ticket=('numero_lineas', 'numero_ventas'), descuento_pct=('descuentos', 'ventas_brutas'),
          participacion_campana_pct=('ventas_con_campana', 'numero_ventas'))},
  store.* EXCLUDE (tienda_id), city.* EXCLUDE (ciudad_id), channel.* EXCLUDE (canal_id)
FROM m_sales m LEFT JOIN store USING (tienda_id) LEFT JOIN city USING (ciudad_id) LEFT JOIN channel USING (canal_id)
""", "m_sales", "store", "city", "channel"))
def mart_sales(spark, sf):
    return marts.sales(silver_lake(spark, sf))


@query("mart_sales_product", sql(f"""
SELECT mes_carga, m.tienda_id, m.ciudad_id, m.canal_id, m.categoria_id, m.producto_id, numero_ventas, lineas_vendidas,
  unidades_vendidas, {dbl('ventas_linea_sin_iva', 'ventas_linea_con_iva', 'costo_total_linea', 'margen_bruto_linea')},
  {ratios(precio_promedio_unitario_sin_iva=('ventas_linea_sin_iva', 'unidades_vendidas'),
          precio_promedio_unitario_con_iva=('ventas_linea_con_iva', 'unidades_vendidas'),
          margen_linea_pct=('margen_bruto_linea', 'ventas_linea_sin_iva'))},
  store.* EXCLUDE (tienda_id), city.* EXCLUDE (ciudad_id), channel.* EXCLUDE (canal_id),
  product.* EXCLUDE (producto_id), category.* EXCLUDE (categoria_id)
FROM m_product m LEFT JOIN store USING (tienda_id) LEFT JOIN city USING (ciudad_id) LEFT JOIN channel USING (canal_id)
LEFT JOIN product USING (producto_id) LEFT JOIN category USING (categoria_id)
""", "m_product", "store", "city", "channel", "product", "category"))
def mart_sales_product(spark, sf):
    return marts.product_sales(silver_lake(spark, sf))


@query("mart_returns", sql(f"""
SELECT r.mes_carga, r.tienda_id, r.ciudad_id, r.categoria_id, r.producto_id, r.motivo_devolucion_id, devoluciones,
  unidades_devueltas, ventas_con_devolucion, lineas_con_devolucion, devoluciones_revision_calidad,
  dias_promedio_hasta_devolucion, numero_ventas, total_lineas_vendidas,
  {dbl('valor_reintegrado', 'ventas_totales', 'margen_bruto')},
  {ratios(tasa_devolucion_ticket=('ventas_con_devolucion', 'numero_ventas'),
          tasa_devolucion_linea=('lineas_con_devolucion', 'total_lineas_vendidas'),
          valor_devuelto_pct=('valor_reintegrado', 'ventas_totales'),
          revision_calidad_pct=('devoluciones_revision_calidad', 'devoluciones'))},
  CAST(ventas_totales - valor_reintegrado AS DOUBLE) AS ventas_netas,
  store.* EXCLUDE (tienda_id), city.* EXCLUDE (ciudad_id), product.* EXCLUDE (producto_id),
  category.* EXCLUDE (categoria_id), reason.* EXCLUDE (motivo_devolucion_id)
FROM m_returns r
LEFT JOIN (SELECT mes_carga, tienda_id, ciudad_id, count(DISTINCT venta_id) AS numero_ventas, sum(valor_total) AS ventas_totales,
             sum(margen_bruto) AS margen_bruto FROM header GROUP BY ALL) USING (mes_carga, tienda_id, ciudad_id)
LEFT JOIN (SELECT mes_carga, tienda_id, ciudad_id, categoria_id, producto_id, count(DISTINCT detalle_venta_id) AS total_lineas_vendidas
           FROM placed GROUP BY ALL) USING (mes_carga, tienda_id, ciudad_id, categoria_id, producto_id)
LEFT JOIN store USING (tienda_id) LEFT JOIN city USING (ciudad_id) LEFT JOIN product USING (producto_id)
LEFT JOIN category USING (categoria_id) LEFT JOIN reason USING (motivo_devolucion_id)
""", "m_returns", "header", "placed", "store", "city", "product", "category", "reason"))
def mart_returns(spark, sf):
    return marts.returns(silver_lake(spark, sf, staged="lines sales"))


@query("mart_marketing", sql(f"""
SELECT mes_carga, m.campana_id, m.ciudad_id, m.canal_id, medio_principal, impresiones, clics, leads, conversiones_atribuidas,
  {dbl('gasto_marketing', 'ventas_atribuidas_valor')},
  {ratios(ctr=('clics', 'impresiones'), cvr_lead=('conversiones_atribuidas', 'leads'), cpc=('gasto_marketing', 'clics'),
          cpl=('gasto_marketing', 'leads'), cpa=('gasto_marketing', 'conversiones_atribuidas'),
          roas=('ventas_atribuidas_valor', 'gasto_marketing'))},
  campaign.* EXCLUDE (campana_id), city.* EXCLUDE (ciudad_id), channel.* EXCLUDE (canal_id)
FROM m_marketing m LEFT JOIN campaign USING (campana_id) LEFT JOIN city USING (ciudad_id) LEFT JOIN channel USING (canal_id)
""", "m_marketing", "campaign", "city", "channel"))
def mart_marketing(spark, sf):
    return marts.marketing(silver_lake(spark, sf))


@query("mart_inventory", sql(f"""
SELECT m.* EXCLUDE (valor_inventario_costo), {dbl('valor_inventario_costo')},
  {ratios(rotacion_inventario=('salidas_ventas', 'stock_promedio'), merma_pct=('merma_unidades', 'stock_inicial'))},
  store.* EXCLUDE (tienda_id), product.* EXCLUDE (producto_id), category.* EXCLUDE (categoria_id)
FROM m_inventory m LEFT JOIN store ON m.tienda_id = store.tienda_id LEFT JOIN product ON m.producto_id = product.producto_id
LEFT JOIN category ON m.categoria_id = category.categoria_id
""", "m_inventory", "store", "product", "category"))
def mart_inventory(spark, sf):
    return marts.inventory(silver_lake(spark, sf))


# joins the terms to every purchase before grouping, the plan our rollup avoids
define("m_purchases", ("bought", "terms", "vendor"), """
SELECT mes_carga, tienda_id, b.proveedor_id, proveedor_nombre, tipo_proveedor, especialidad, estado_proveedor,
  b.producto_id, categoria_id, motivo_compra, count(DISTINCT orden_compra_id) AS ordenes_compra,
  CAST(sum(cantidad_comprada) AS BIGINT) AS cantidad_comprada, sum(subtotal_sin_iva) AS subtotal_compras,
  sum(iva_valor) AS iva_compras, sum(valor_total_compra) AS compras_totales,
  count(*) FILTER (estado_orden = 'Recibida') AS ordenes_recibidas,
  count(*) FILTER (estado_orden IN ('Pendiente', 'Parcial')) AS ordenes_abiertas,
  CAST(sum(costo_negociado) AS DOUBLE) / nullif(count(costo_negociado), 0) AS costo_negociado_promedio,
  CAST(sum(coalesce(lead_time_dias, lead_time_promedio_dias)) AS DOUBLE)
    / nullif(count(coalesce(lead_time_dias, lead_time_promedio_dias)), 0) AS lead_time_promedio_proveedor,
  sum(calificacion_servicio) / nullif(count(calificacion_servicio), 0) AS calificacion_servicio_promedio
FROM bought b LEFT JOIN terms t ON b.producto_id = t.producto_id AND b.proveedor_id = t.proveedor_id
LEFT JOIN vendor v ON b.proveedor_id = v.proveedor_id GROUP BY ALL""")
define("m_purchases2", ("m_purchases",), f"""
SELECT *, {share('compras_totales', 'cantidad_comprada')} AS costo_unitario_promedio_con_iva,
  {share('subtotal_compras', 'cantidad_comprada')} AS costo_sin_iva_promedio,
  {share('ordenes_recibidas', 'ordenes_compra')} AS ordenes_recibidas_pct FROM m_purchases""")


@query("mart_purchases", sql(f"""
SELECT m.* EXCLUDE (subtotal_compras, iva_compras, compras_totales), {dbl('subtotal_compras', 'iva_compras', 'compras_totales')},
  costo_sin_iva_promedio - costo_negociado_promedio AS variacion_vs_costo_negociado,
  (costo_sin_iva_promedio - costo_negociado_promedio) / nullif(costo_negociado_promedio, 0) AS variacion_vs_costo_negociado_pct,
  store.* EXCLUDE (tienda_id), product.* EXCLUDE (producto_id), category.* EXCLUDE (categoria_id)
FROM m_purchases2 m LEFT JOIN store ON m.tienda_id = store.tienda_id LEFT JOIN product ON m.producto_id = product.producto_id
LEFT JOIN category ON m.categoria_id = category.categoria_id
""", "m_purchases2", "store", "product", "category"))
def mart_purchases(spark, sf):
    return marts.purchases(silver_lake(spark, sf, staged="lines"))


@query("mart_logistics", sql(f"""
SELECT m.* EXCLUDE (costo_envio_total), {dbl('costo_envio_total', 'ventas_totales_asociadas')},
  {ratios(entregas_a_tiempo_pct=('entregas_a_tiempo', 'entregas'), entregas_pendientes_pct=('entregas_pendientes', 'entregas'),
          costo_envio_promedio=('costo_envio_total', 'entregas'), costo_por_kg=('costo_envio_total', 'peso_total_kg'),
          costo_logistico_sobre_venta_pct=('costo_envio_total', 'ventas_totales_asociadas'))},
  store.* EXCLUDE (tienda_id), channel.* EXCLUDE (canal_id), carrier.* EXCLUDE (transportista_id),
  o.ciudad_nombre AS ciudad_origen_nombre, o.ciudad_departamento AS departamento_origen, o.ciudad_region AS region_origen,
  d.ciudad_nombre AS ciudad_destino_nombre, d.ciudad_departamento AS departamento_destino, d.ciudad_region AS region_destino
FROM m_logistics m
LEFT JOIN (SELECT mes_carga, tienda_id, canal_id, sum(valor_total) AS ventas_totales_asociadas FROM header GROUP BY ALL) v
  ON m.mes_carga = v.mes_carga AND m.tienda_id = v.tienda_id AND m.canal_id = v.canal_id
LEFT JOIN store ON m.tienda_id = store.tienda_id LEFT JOIN channel ON m.canal_id = channel.canal_id
LEFT JOIN carrier ON m.transportista_id = carrier.transportista_id
LEFT JOIN city o ON o.ciudad_id = m.ciudad_origen_id LEFT JOIN city d ON d.ciudad_id = m.ciudad_destino_id
""", "m_logistics", "header", "store", "channel", "carrier", "city"))
def mart_logistics(spark, sf):
    return marts.logistics(silver_lake(spark, sf, staged="lines"))


@query("mart_finance", sql(f"""
SELECT mes_carga, m.tienda_id, {dbl('presupuesto', 'ejecutado', 'costos_presupuestados', 'costos_reales', 'ventas_totales',
                                  'ventas_sin_iva', 'margen_bruto')}, numero_ventas,
  CAST(ejecutado - presupuesto AS DOUBLE) AS variacion_presupuesto,
  CAST(costos_reales - costos_presupuestados AS DOUBLE) AS variacion_costos,
  CAST(margen_bruto - costos_reales AS DOUBLE) AS margen_despues_costos,
  {ratios(variacion_presupuesto_pct=('(ejecutado - presupuesto)', 'presupuesto'),
          ejecucion_presupuesto_pct=('ejecutado', 'presupuesto'),
          variacion_costos_pct=('(costos_reales - costos_presupuestados)', 'costos_presupuestados'),
          costos_sobre_ventas_pct=('costos_reales', 'ventas_totales'),
          margen_despues_costos_pct=('(margen_bruto - costos_reales)', 'ventas_sin_iva'))},
  store.* EXCLUDE (tienda_id)
FROM m_finance m LEFT JOIN store ON m.tienda_id = store.tienda_id
""", "m_finance", "store"))
def mart_finance(spark, sf):
    return marts.finance(silver_lake(spark, sf, staged="lines"))


@query("mart_targets", sql(f"""
SELECT mes_carga, m.tienda_id, {dbl('meta_ventas', 'meta_margen_bruto', 'ventas_totales', 'ventas_sin_iva', 'margen_bruto')},
  {whole('meta_tickets', 'meta_tickets')}, meta_tasa_devolucion, {whole('meta_entregas', 'meta_entregas')},
  numero_ventas, devoluciones, entregas,
  {ratios(cumplimiento_ventas_pct=('ventas_totales', 'meta_ventas'), cumplimiento_tickets_pct=('numero_ventas', 'meta_tickets'),
          cumplimiento_margen_pct=('margen_bruto', 'meta_margen_bruto'), tasa_devolucion_ticket=('devoluciones', 'numero_ventas'),
          entregas_vs_meta=('entregas', 'meta_entregas'))},
  {share('devoluciones', 'numero_ventas')} / nullif(meta_tasa_devolucion, 0) AS tasa_devolucion_vs_meta,
  CAST(ventas_totales - meta_ventas AS DOUBLE) AS brecha_ventas, {whole('numero_ventas - meta_tickets', 'brecha_tickets')},
  CAST(margen_bruto - meta_margen_bruto AS DOUBLE) AS brecha_margen,
  {share('ventas_totales', 'meta_ventas')} >= 1 AS cumple_meta_ventas,
  {share('numero_ventas', 'meta_tickets')} >= 1 AS cumple_meta_tickets,
  {share('margen_bruto', 'meta_margen_bruto')} >= 1 AS cumple_meta_margen,
  store.* EXCLUDE (tienda_id)
FROM m_targets m LEFT JOIN store ON m.tienda_id = store.tienda_id
""", "m_targets", "store"))
def mart_targets(spark, sf):
    return marts.targets(silver_lake(spark, sf, staged="lines"))


define("kpi", ("m_sales", "m_product", "m_returns", "m_inventory", "m_logistics", "m_marketing", "m_finance", "m_targets"), """
SELECT * FROM
(SELECT mes_carga, sum(ventas_totales) AS ventas_totales, sum(ventas_sin_iva) AS ventas_sin_iva, sum(margen_bruto) AS margen_bruto,
   CAST(sum(numero_ventas) AS BIGINT) AS numero_ventas FROM m_sales GROUP BY 1)
LEFT JOIN (SELECT mes_carga, CAST(sum(unidades_vendidas) AS BIGINT) AS unidades_vendidas FROM m_product GROUP BY 1) USING (mes_carga)
LEFT JOIN (SELECT mes_carga, CAST(sum(devoluciones) AS BIGINT) AS devoluciones, sum(valor_reintegrado) AS valor_reintegrado
           FROM m_returns GROUP BY 1) USING (mes_carga)
LEFT JOIN (SELECT mes_carga, sum(cobertura_dias_promedio) / count(cobertura_dias_promedio) AS cobertura_dias_promedio,
             CAST(sum(productos_bajo_reorden) AS BIGINT) AS productos_bajo_reorden FROM m_inventory GROUP BY 1) USING (mes_carga)
LEFT JOIN (SELECT mes_carga, CAST(sum(entregas) AS BIGINT) AS entregas, CAST(sum(entregas_a_tiempo) AS BIGINT) AS entregas_a_tiempo,
             sum(costo_envio_total) AS costo_envio_total FROM m_logistics GROUP BY 1) USING (mes_carga)
LEFT JOIN (SELECT mes_carga, sum(gasto_marketing) AS gasto_marketing, sum(ventas_atribuidas_valor) AS ventas_atribuidas_valor
           FROM m_marketing GROUP BY 1) USING (mes_carga)
LEFT JOIN (SELECT mes_carga, sum(presupuesto) AS presupuesto, sum(ejecutado) AS ejecutado, sum(costos_reales) AS costos_reales
           FROM m_finance GROUP BY 1) USING (mes_carga)
LEFT JOIN (SELECT mes_carga, sum(meta_ventas) AS meta_ventas, sum(ventas_totales) AS ventas_objetivo_totales
           FROM m_targets GROUP BY 1) USING (mes_carga)""")


def month_products(spark, sf):
    """The cores the KPIs start from, over lines that are deduplicated and priced once."""
    lake = silver_lake(spark, sf, staged="lines sales")
    return lake, {name: core(lake) for name, core in marts.CORES.items()}


@query("mart_kpis", sql(f"""
SELECT mes_carga, numero_ventas, unidades_vendidas, devoluciones, cobertura_dias_promedio, productos_bajo_reorden, entregas,
  entregas_a_tiempo, {dbl('ventas_totales', 'ventas_sin_iva', 'margen_bruto', 'valor_reintegrado', 'costo_envio_total',
                          'gasto_marketing', 'ventas_atribuidas_valor', 'presupuesto', 'ejecutado', 'costos_reales',
                          'meta_ventas', 'ventas_objetivo_totales')},
  CAST(ventas_totales - coalesce(valor_reintegrado, 0) AS DOUBLE) AS ventas_netas,
  {ratios(margen_bruto_pct=('margen_bruto', 'ventas_sin_iva'), ticket_promedio=('ventas_totales', 'numero_ventas'),
          tasa_devolucion=('devoluciones', 'numero_ventas'), valor_reintegrado_pct=('valor_reintegrado', 'ventas_totales'),
          entregas_a_tiempo_pct=('entregas_a_tiempo', 'entregas'),
          costo_logistico_sobre_venta_pct=('costo_envio_total', 'ventas_totales'),
          marketing_roas=('ventas_atribuidas_valor', 'gasto_marketing'), ejecucion_presupuesto_pct=('ejecutado', 'presupuesto'),
          costos_sobre_ventas_pct=('costos_reales', 'ventas_totales'),
          cumplimiento_ventas_pct=('ventas_objetivo_totales', 'meta_ventas'))}
FROM kpi""", "kpi"))
def mart_kpis(spark, sf):
    _, products = month_products(spark, sf)
    return marts.kpis(products)


define("lined_up", ("kpi", "header", "back", "control"), """
SELECT k.mes_carga, k.numero_ventas AS gold_numero_ventas, s.numero_ventas AS silver_numero_ventas, c.ventas AS control_numero_ventas,
  k.ventas_totales AS gold_ventas_totales, s.ventas_totales AS silver_ventas_totales, c.valor_total AS control_ventas_totales,
  k.margen_bruto AS gold_margen_bruto, s.margen_bruto AS silver_margen_bruto, c.margen_bruto AS control_margen_bruto,
  k.devoluciones AS gold_devoluciones, r.devoluciones AS silver_devoluciones, c.devoluciones AS control_devoluciones,
  k.valor_reintegrado AS gold_valor_reintegrado, r.valor_reintegrado AS silver_valor_reintegrado,
  c.valor_reintegrado AS control_valor_reintegrado
FROM kpi k
LEFT JOIN (SELECT mes_carga, count(DISTINCT venta_id) AS numero_ventas, sum(valor_total) AS ventas_totales, sum(margen_bruto) AS margen_bruto
           FROM header GROUP BY 1) s ON k.mes_carga = s.mes_carga
LEFT JOIN (SELECT mes_carga, count(DISTINCT devolucion_id) AS devoluciones, sum(valor_reintegrado) AS valor_reintegrado
           FROM back GROUP BY 1) r ON k.mes_carga = r.mes_carga
LEFT JOIN control c ON k.mes_carga = c.mes_carga""")

MONEY_FIGURES = dbl(*[f"{side}_{m}" for m in ("ventas_totales", "margen_bruto", "valor_reintegrado")
                      for side in ("gold", "silver", "control")])
COUNT_FIGURES = ", ".join(f"{side}_{m}" for m in ("numero_ventas", "devoluciones") for side in ("gold", "silver", "control"))


def _flags(side: str, null_safe: bool) -> dict[str, str]:
    out = {}
    for flag, m, tolerant in (("ventas", "ventas_totales", True), ("margen", "margen_bruto", True),
                              ("tickets", "numero_ventas", False), ("devoluciones", "devoluciones", False),
                              ("valor_reintegrado", "valor_reintegrado", True)):
        a, b = f"gold_{m}", f"{side}_{m}"
        same = f"abs({a} - {b}) <= 0.05" if tolerant else f"{a} = {b}"
        out[f"{flag}_match_{side}"] = f"coalesce({same}, {a} IS NULL AND {b} IS NULL)" if null_safe else f"({same})"
    return out


def _verdict(flags: dict[str, str]) -> str:
    return "CASE WHEN " + " AND ".join(flags.values()) + " THEN 'PASS' ELSE 'FAIL' END"


def _select(flags: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in flags.items())


STRICT, SAFE, CONTROL = _flags("silver", False), _flags("silver", True), _flags("control", True)


@query("gold_reconciliation", sql(f"""
SELECT mes_carga, {COUNT_FIGURES}, {MONEY_FIGURES}, {_select(STRICT)}, {_verdict(STRICT)} AS gold_quality_status
FROM lined_up""", "lined_up"))
def gold_reconciliation(spark, sf):
    lake, products = month_products(spark, sf)
    return gold_checks(marts.kpis(products), lake)


@query("gold_reconciliation_control", sql(f"""
SELECT mes_carga, {COUNT_FIGURES}, {MONEY_FIGURES}, {_select(SAFE)}, {_select(CONTROL)},
  {_verdict(SAFE)} AS gold_quality_status, {_verdict(CONTROL)} AS control_status
FROM lined_up""", "lined_up"))
def gold_reconciliation_control(spark, sf):
    lake, products = month_products(spark, sf)
    return gold_checks(marts.kpis(products), lake, against_control=True)


# --- products by month ---------------------------------------------------------------------------

LATE_MONTHS = ("1995-03", "1996-07")


@query("gold_after_late_file", sql(f"""
SELECT mes_carga, tienda_id, ciudad_id, canal_id, CAST(sum(CASE WHEN tarde THEN 2 * valor_total ELSE valor_total END) AS DOUBLE) AS ventas_totales,
  count(*) AS numero_ventas, mes_carga IN {LATE_MONTHS} AS reescrito
FROM (SELECT *, mes_carga IN {LATE_MONTHS} AND CAST(venta_id AS BIGINT) % 2 = 0 AS tarde FROM header) GROUP BY ALL""", "header"))
def gold_after_late_file(spark, sf):
    """Sales by month are published, corrections of two months come late, and only these months are built and written again."""
    settings, product = Settings(new_folder(spark, "late-gold"), "comercial", "2001"), "mart_ventas_mensual"
    lake = silver_lake(spark, sf, staged="sales")
    names = ("fact_ventas_cabecera", "dim_tienda", "dim_ciudad", "dim_canal_venta")
    for name in names:
        year, month = (F.split(F.col(fv.MONTH), "-")[k] if name.startswith("fact_") else F.lit(None).cast("string") for k in (0, 1))
        rows = lake[name].withColumns({fv.SOURCE_YEAR: year, fv.SOURCE_MONTH: month})
        LakeTable(spark, settings.table_path("silver", name), PARTITIONS).publish(rows)
    domains = dict.fromkeys(names, settings.domain)
    gold.refresh_changed(spark, settings, domains, only=[product])
    published = gold.product_table(spark, settings, product)
    before = published.folders()
    sales = LakeTable(spark, settings.table_path("silver", names[0]), PARTITIONS)
    late = sales.read().filter(F.col(fv.MONTH).isin(*LATE_MONTHS) & (F.col("venta_id").cast("bigint") % 2 == 0))
    sales.upsert(late.withColumn("valor_total", (F.col("valor_total") * 2).cast(late.schema["valor_total"].dataType)), ["venta_id"])
    gold.refresh_changed(spark, settings, domains, only=[product])
    written = published.folders().join(before, "carpeta", "left_anti").select(
        F.regexp_extract("carpeta", f"{fv.MONTH}=(.*)$", 1).alias(fv.MONTH), F.lit(True).alias("nuevo"))
    return published.read().join(written, fv.MONTH, "left").select(
        fv.MONTH, "tienda_id", "ciudad_id", "canal_id", "ventas_totales", "numero_ventas", F.coalesce("nuevo", F.lit(False)).alias("reescrito"))
