"""Row-wise rules: typing, cleaning, flags, null policy, codes, derived measures, step state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from suite.registry import query, table
from suite.sql import dbl, define, share, sql
from suite.tables import base_lake, employees, month, silver_lake, text
from tidemark import fixed_values as fv
from tidemark.functions.columns import month_key
from tidemark.operators import standardize as std
from tidemark.plans.silver import run_step


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


# --- text landed from a file: whole tables as strings, some cells spoilt ----------------

def spoilt(c: Column, condition: Column, by: str) -> Column:
    return F.when(condition, F.lit(by)).otherwise(c)


def landed_orders(spark, sf) -> DataFrame:
    """Orders as a landed file would hold them: all text, padded, some cells unusable."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("00"), text("o_orderkey")).alias("venta_id"),
        spoilt(F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")), key % 11 == 0, "2026-13-45").alias("fecha_venta"),
        spoilt(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), key % 13 == 0, "12,5").alias("valor_total"),
        F.when(key % 5 == 0, " ").when(key % 5 == 1, "  SI ").when(key % 5 == 2, "sí").when(key % 5 == 3, "0")
        .otherwise("maybe").alias("requiere_logistica"),
        F.concat((key % 9).cast("string"), F.when(key % 2 == 0, ".0").otherwise("")).alias("numero_lineas"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.when(key % 3 == 0, "-01 00:00:00").otherwise(" ")).alias("mes_carga"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("estado_venta"),
    )


define("landed_orders", (), """
SELECT '00' || CAST(o_orderkey AS VARCHAR) AS venta_id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha_venta,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor_total,
  CASE o_orderkey % 5 WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN false END AS requiere_logistica,
  o_orderkey % 9 AS numero_lineas, strftime(o_orderdate, '%Y-%m') AS mes_carga, o_orderpriority AS estado_venta
FROM orders""")


@query("standardize_orders", sql("SELECT * FROM landed_orders", "landed_orders"))
def standardize_orders(spark, sf):
    return std.standardize(landed_orders(spark, sf))


@query("standardize_lineitem", sql("""
SELECT CAST(l_orderkey AS VARCHAR) AS venta_id, CAST(l_quantity AS BIGINT) AS cantidad,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS precio_unitario,
  CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(CAST(l_discount AS DECIMAL(10,4)) AS DOUBLE) END AS descuento_pct,
  CAST(l_suppkey AS VARCHAR) AS sku, l_quantity AS peso_estimado_kg,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS estado_linea,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS fecha_entrega
FROM lineitem"""))
def standardize_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    landed = li.select(
        text("l_orderkey").alias("venta_id"), text("l_quantity").alias("cantidad"),
        text("l_extendedprice").alias("precio_unitario"),
        spoilt(text("l_discount"), F.col("l_partkey") % 10 == 0, "n/a").alias("descuento_pct"),
        F.col("l_suppkey").alias("sku"), text("l_quantity").alias("peso_estimado_kg"),
        spoilt(F.col("l_returnflag"), F.col("l_linenumber") == 1, "   ").alias("estado_linea"),
        spoilt(F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_linenumber") == 2, "ayer").alias("fecha_entrega"))
    return std.standardize(landed)


@query("clean_strings", """
SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name END AS c_name, c_mktsegment FROM customer""")
def clean_strings(spark, sf):
    c = table(spark, sf, "customer")
    padded = c.select(
        "c_custkey", spoilt(F.concat(F.lit("  "), "c_name", F.lit(" ")), F.col("c_custkey") % 6 == 0, "    ").alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"))
    return std.blank_to_null(padded)


FLAG_WORDS = ["TRUE", " t", "1", "Yes", "y ", "SI", "s", "Sí", "False", "F", "0", "no", "N", "maybe", "", "2"]


@query("parse_flags", f"""
SELECT l_returnflag, l_linestatus, activa, count(*) AS filas FROM (
  SELECT l_returnflag, l_linestatus, CASE WHEN l_partkey % 17 = 16 THEN NULL
    WHEN l_partkey % 17 < 8 THEN true WHEN l_partkey % 17 < 13 THEN false END AS activa FROM lineitem)
GROUP BY ALL""")
def parse_flags(spark, sf):
    spelled = F.try_element_at(F.array(*[F.lit(w) for w in FLAG_WORDS]), (F.col("l_partkey") % 17 + 1).cast("int"))
    typed = std.type_by_name(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", spelled.alias("activa")))
    return typed.groupBy("l_returnflag", "l_linestatus", "activa").agg(F.count("*").alias("filas"))


@query("month_key_extract", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (3, 4) THEN NULL ELSE strftime(o_orderdate, '%Y-%m') END AS mes FROM orders""")
def month_key_extract(spark, sf):
    k, iso = F.col("o_orderkey") % 6, F.date_format("o_orderdate", "yyyy-MM")
    shown = (
        F.when(k == 0, iso).when(k == 1, F.concat(iso, F.lit("-15"))).when(k == 2, F.concat(F.lit("  "), iso, F.lit("-01 00:00:00")))
        .when(k == 3, F.date_format("o_orderdate", "yyyyMM")).when(k == 4, F.date_format("o_orderdate", "MM/yyyy"))
        .otherwise(F.concat(iso, F.lit(" "))))
    return table(spark, sf, "orders").select("o_orderkey", month_key(shown).alias("mes"))


# --- null policy --------------------------------------------------------------------------

@query("null_policy_conditional", """
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS fecha_id, day(o_orderdate) = 1 AS es_festivo_colombia,
  CASE WHEN day(o_orderdate) = 1 THEN 'Festivo ' || strftime(o_orderdate, '%m') END AS festivo_nombre
FROM orders JOIN customer ON o_custkey = c_custkey""")
def null_policy_conditional(spark, sf):
    return std.explain_nulls("dim_fecha", base_lake(spark, sf)["dim_fecha"])


@query("null_policy_sentinel", """
SELECT CAST(c_custkey AS VARCHAR) AS empleado_id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS tienda_id,
  CAST(c_nationkey AS VARCHAR) AS area_id, c_custkey % 7 = 0 AS es_empleado_corporativo,
  CASE WHEN c_custkey % 7 = 0 THEN 'NO_APLICA' ELSE c_mktsegment END AS tienda_id_modelo FROM customer""")
def null_policy_sentinel(spark, sf):
    return std.explain_nulls("dim_empleado", employees(spark, sf))


@query("null_policy_reason", sql("""
SELECT tabla, motivo_repartidor, motivo_fecha, motivo_campana, count(*) AS filas FROM (
  SELECT 'entregas' AS tabla,
    CASE WHEN empleado_repartidor_id IS NULL THEN CASE WHEN CAST(transportista_id AS INT) <> 3 THEN 'transportista_tercero'
         ELSE 'sin_repartidor_informado' END END AS motivo_repartidor,
    CASE WHEN fecha_entrega IS NULL THEN CASE WHEN estado_entrega = 'Cancelado en ruta' THEN 'cancelado_en_ruta'
         ELSE 'pendiente_o_no_entregado' END END AS motivo_fecha, CAST(NULL AS VARCHAR) AS motivo_campana FROM shipped
  UNION ALL
  SELECT 'ventas', NULL, NULL, CASE WHEN campana_id IS NULL THEN 'venta_sin_campana' END FROM header)
GROUP BY ALL""", "shipped", "header"))
def null_policy_reason(spark, sf):
    lake = base_lake(spark, sf, staged="lines")
    no_carrier_three = F.when(F.col("transportista_id") != "3", F.col("transportista_id"))
    sent = std.explain_nulls("fact_logistica_entregas",
                             lake["fact_logistica_entregas"].withColumn("transportista_id", no_carrier_three))
    sold = std.explain_nulls("fact_ventas_cabecera", lake["fact_ventas_cabecera"])
    empty = F.lit(None).cast("string")
    reasons = sent.select(F.lit("entregas").alias("tabla"),
                          F.col("empleado_repartidor_null_reason").alias("motivo_repartidor"),
                          F.col("fecha_entrega_null_reason").alias("motivo_fecha"), empty.alias("motivo_campana")) \
        .unionAll(sold.select(F.lit("ventas"), empty, empty, "campana_null_reason"))
    return reasons.groupBy(*reasons.columns).agg(F.count("*").alias("filas"))


# --- domain codes -------------------------------------------------------------------------

def code_sql(c: str) -> str:
    return f"lower(regexp_replace(regexp_replace(trim({c}), '[^A-Za-z0-9]+', '_', 'g'), '^_|_$', '', 'g'))"


@query("domain_codes", f"""
SELECT o_orderkey, estado_venta, {code_sql('estado_venta')} AS estado_venta_codigo,
  estado_venta IS NULL OR estado_venta IN ({quoted(fv.ALLOWED_VALUES['estado_venta'])}) AS estado_venta_codigo_valido,
  segmento_cliente, {code_sql('segmento_cliente')} AS segmento_cliente_codigo,
  tipo_mascota_principal, {code_sql('tipo_mascota_principal')} AS tipo_mascota_codigo
FROM (SELECT o_orderkey, o_orderpriority AS estado_venta, '(' || c_mktsegment || ') / ' || o_orderstatus AS segmento_cliente,
        'En revisión ' || n_name AS tipo_mascota_principal
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""")
def domain_codes(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    labelled = (
        table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", F.col("o_orderpriority").alias("estado_venta"),
                F.concat(F.lit("("), "c_mktsegment", F.lit(") / "), "o_orderstatus").alias("segmento_cliente"),
                F.concat(F.lit("En revisión "), "n_name").alias("tipo_mascota_principal")))
    return std.add_domain_codes(labelled)


@query("domain_valid_flags", sql(f"""
SELECT tabla, estado, valido, count(*) AS filas FROM (
  SELECT 'entregas' AS tabla, estado_entrega AS estado,
    estado_entrega IS NULL OR estado_entrega IN ({quoted(fv.ALLOWED_VALUES['estado_entrega'])}) AS valido FROM shipped
  UNION ALL SELECT 'devoluciones', estado_devolucion, true FROM back
  UNION ALL SELECT 'compras', estado_orden, true FROM bought
  UNION ALL SELECT 'existencias', CASE WHEN stock_final > 200 THEN 'Sobrestock' WHEN stock_final > 20 THEN 'Normal' ELSE 'Roto' END,
    stock_final > 20 FROM stock)
GROUP BY ALL""", "shipped", "back", "bought", "stock"))
def domain_valid_flags(spark, sf):
    lake = base_lake(spark, sf, staged="lines")
    stock = F.when(F.col("stock_final") > 200, "Sobrestock").when(F.col("stock_final") > 20, "Normal").otherwise("Roto")
    parts = [
        ("entregas", lake["fact_logistica_entregas"], "estado_entrega"),
        ("devoluciones", lake["fact_devoluciones"], "estado_devolucion"),
        ("compras", lake["fact_compras"], "estado_orden"),
        ("existencias", lake["fact_inventario_mensual"].withColumn("estado_stock", stock), "estado_stock"),
    ]
    out = None
    for label, df, c in parts:
        one = std.add_domain_codes(df).groupBy(F.col(c).alias("estado"), F.col(f"{c}_codigo_valido").alias("valido")).agg(
            F.count("*").alias("filas")).select(F.lit(label).alias("tabla"), "estado", "valido", "filas")
        out = one if out is None else out.unionAll(one)
    return out


# --- derived measures ---------------------------------------------------------------------

def derived(name: str, target: str, key: str, measures: dict[str, str], source: str):
    """One derive_* query: a table's key and its measures."""
    columns = ", ".join(f"{e} AS {c}" for c, e in measures.items())

    def build(spark, sf):
        return silver_lake(spark, sf)[target].select(*key.split(", "), *measures)

    query(name, sql(f"SELECT {key}, {columns} FROM {source}", source))(build)


define("list_price", (), "SELECT CAST(p_partkey AS VARCHAR) AS producto_id, CAST(p_retailprice AS DECIMAL(18,2)) AS p, CAST(p_size AS DECIMAL(18,2)) AS c FROM part")
define("adjusted", ("lines",), "SELECT 'A' || detalle_venta_id AS ajuste_id, CASE WHEN l_tax = 0 THEN cantidad ELSE 0 END AS merma_unidades FROM lines")

derived("derive_part", "dim_producto", "producto_id", {"margen_lista_pct": share("(p - c)", "p")}, "list_price")
derived("derive_sales_header", "fact_ventas_cabecera", "venta_id", {
    "base_neta_sin_iva": "CAST(base_neta_sin_iva AS DOUBLE)", "margen_pct": share("margen_bruto", "base_neta_sin_iva"),
    "descuento_pct_real": share("descuento_total", "valor_bruto"),
    "ticket_lineas_promedio": share("valor_total", "numero_lineas"), "tiene_campana": "campana_id IS NOT NULL"}, "header")
derived("derive_sales_line", "fact_ventas_detalle", "detalle_venta_id", {
    "precio_neto_unitario_sin_iva": share("base_sin_iva", "cantidad"),
    "precio_unitario_con_iva": share("valor_total_linea", "cantidad"),
    "margen_linea_pct": share("margen_bruto_linea", "base_sin_iva"), "descuento_aplicado": "descuento_valor > 0"}, "placed")
derived("derive_returns", "fact_devoluciones", "devolucion_id", {
    "devolucion_finalizada": "estado_devolucion IN ('Aprobada', 'Rechazada')",
    "devolucion_en_revision": "estado_devolucion = 'En revision'", "dias_hasta_devolucion": "dias_hasta_devolucion"}, "back")
derived("derive_marketing", "fact_marketing", "marketing_id", {
    "ctr": share("clics", "impresiones"), "conversion_rate": share("conversiones_atribuidas", "leads"),
    "cpc": share("gasto_marketing", "clics"), "cpl": share("gasto_marketing", "leads"),
    "roas_calculado": share("ventas_atribuidas_valor", "gasto_marketing")}, "promoted")
derived("derive_inventory", "fact_inventario_mensual", "mes_carga, tienda_id, producto_id", {
    c: c for c in ("stock_promedio", "alerta_reorden", "alerta_stock_seguridad", "rotacion_estimada")}, "stock")
derived("derive_adjustments", "fact_ajustes_inventario", "ajuste_id", {"impacto_merma": "merma_unidades > 0"}, "adjusted")
derived("derive_purchases", "fact_compras", "orden_compra_id", {
    "costo_compra_promedio_sin_iva": share("subtotal_sin_iva", "cantidad_comprada"),
    "costo_compra_promedio_con_iva": share("valor_total_compra", "cantidad_comprada"),
    "iva_pct_real": share("iva_valor", "subtotal_sin_iva"), "orden_recibida": "estado_orden = 'Recibida'",
    "orden_abierta": "estado_orden IN ('Pendiente', 'Parcial')"}, "bought")
derived("derive_delivery", "fact_logistica_entregas", "entrega_id", {
    c: c for c in ("entrega_a_tiempo", "entrega_tardia", "entrega_fallida", "entrega_cancelada", "entrega_pendiente",
                   "tipo_entrega_operativa", "costo_por_kg")}, "delivered")
derived("derive_costs", "fact_costos_mensual", "costo_id", {
    "variacion_costo": "CAST(monto_real - monto_presupuestado AS DOUBLE)",
    "variacion_costo_pct": share("(monto_real - monto_presupuestado)", "monto_presupuestado")}, "spent")
derived("derive_budget", "fact_presupuesto_mensual", "presupuesto_id", {
    "ejecucion_presupuesto_pct": share("monto_ejecutado", "monto_presupuesto")}, "planned")


# --- step state ---------------------------------------------------------------------------

@query("pending_step_rows", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'domain_normalization' ELSE 'null_corrections' END AS paso,
  count(*) AS filas, count(*) FILTER (o_orderkey % 2 = 0) AS con_codigo FROM orders GROUP BY 1""")
def pending_step_rows(spark, sf):
    """All orders take two steps, half of them the third; how many stand at which step?"""
    o = table(spark, sf, "orders").select(text("o_orderkey").alias("venta_id"), F.col("o_orderstatus").alias("campana_id"),
                                          F.col("o_orderpriority").alias("estado_venta"))
    typed = run_step("schema_standardization", "fact_ventas_cabecera", o, domain="comercial")
    explained = run_step("null_corrections", "fact_ventas_cabecera", std.awaiting(typed, fv.STEPS[0]), domain="comercial")
    waiting = std.awaiting(explained, fv.STEPS[1])
    even = F.col("venta_id").cast("bigint") % 2 == 0
    coded = run_step("domain_normalization", "fact_ventas_cabecera", waiting.filter(even), domain="comercial")
    everyone = waiting.filter(~even).unionByName(coded, allowMissingColumns=True)
    return everyone.groupBy(F.col(fv.SILVER_STEP).alias("paso")).agg(
        F.count("*").alias("filas"), F.count("estado_venta_codigo").alias("con_codigo"))
