"""Silver step four: measures derived row by row, per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import ratio


def _gap(a: str, b: str) -> Column:
    return F.col(a) - F.col(b)


def _is(column: str, *labels: str) -> Column:
    return F.col(column).isin(*labels)


def product() -> dict[str, Column]:
    return {"margen_lista_pct": ratio(_gap("precio_lista", "costo_estandar"), "precio_lista")}


def sales_header() -> dict[str, Column]:
    net = _gap("valor_bruto", "descuento_total")
    return {
        "base_neta_sin_iva": net,
        "margen_pct": ratio("margen_bruto", net),
        "descuento_pct_real": ratio("descuento_total", "valor_bruto"),
        "ticket_lineas_promedio": ratio("valor_total", "numero_lineas"),
        "tiene_campana": F.col("campana_id").isNotNull(),
    }


def sales_line() -> dict[str, Column]:
    return {
        "precio_neto_unitario_sin_iva": ratio("base_sin_iva", "cantidad"),
        "precio_unitario_con_iva": ratio("valor_total_linea", "cantidad"),
        "margen_linea_pct": ratio("margen_bruto_linea", "base_sin_iva"),
        "descuento_aplicado": F.col("descuento_valor") > 0,
    }


def returns() -> dict[str, Column]:
    return {
        "devolucion_finalizada": _is("estado_devolucion", "Aprobada", "Rechazada"),
        "devolucion_en_revision": _is("estado_devolucion", "En revision"),
    }


def marketing() -> dict[str, Column]:
    return {
        "ctr": ratio("clics", "impresiones"),
        "conversion_rate": ratio("conversiones_atribuidas", "leads"),
        "cpc": ratio("gasto_marketing", "clics"),
        "cpl": ratio("gasto_marketing", "leads"),
        "roas_calculado": ratio("ventas_atribuidas_valor", "gasto_marketing"),
    }


def inventory() -> dict[str, Column]:
    average = (F.col("stock_inicial") + F.col("stock_final")).cast("double") / 2
    return {
        "stock_promedio": average,
        "alerta_reorden": F.col("stock_final") <= F.col("punto_reorden"),
        "alerta_stock_seguridad": F.col("stock_final") <= F.col("stock_seguridad"),
        "rotacion_estimada": ratio("salidas_ventas", average),
    }


def adjustments() -> dict[str, Column]:
    return {"impacto_merma": F.col("merma_unidades") > 0}


def purchases() -> dict[str, Column]:
    return {
        "costo_compra_promedio_sin_iva": ratio("subtotal_sin_iva", "cantidad_comprada"),
        "costo_compra_promedio_con_iva": ratio("valor_total_compra", "cantidad_comprada"),
        "iva_pct_real": ratio("iva_valor", "subtotal_sin_iva"),
        "orden_recibida": _is("estado_orden", "Recibida"),
        "orden_abierta": _is("estado_orden", "Pendiente", "Parcial"),
    }


def delivery() -> dict[str, Column]:
    """Delivery flags keep three-valued logic: an unknown delay gives NULL, not false."""
    arrived = F.col("fecha_entrega").isNotNull()
    delay = F.col("dias_retraso")
    own_courier = F.col("empleado_repartidor_id").isNotNull()
    return {
        "entrega_a_tiempo": _is("estado_entrega", "Entregado") & arrived & (delay <= 0),
        "entrega_tardia": _is("estado_entrega", "Entregado tarde") | (arrived & (delay > 0)),
        "entrega_fallida": _is("estado_entrega", "Intento fallido"),
        "entrega_cancelada": _is("estado_entrega", "Cancelado en ruta"),
        "entrega_pendiente": ~arrived,
        "tipo_entrega_operativa": F.when(own_courier, "Interna").otherwise("Tercero"),
        "costo_por_kg": ratio("costo_envio", "peso_estimado_kg"),
    }


def costs() -> dict[str, Column]:
    over = _gap("monto_real", "monto_presupuestado")
    return {"variacion_costo": over, "variacion_costo_pct": ratio(over, "monto_presupuestado")}


def budget() -> dict[str, Column]:
    return {"ejecucion_presupuesto_pct": ratio("monto_ejecutado", "monto_presupuesto")}


MEASURES = {
    "dim_producto": product,
    "fact_ventas_cabecera": sales_header,
    "fact_ventas_detalle": sales_line,
    "fact_devoluciones": returns,
    "fact_marketing": marketing,
    "fact_inventario_mensual": inventory,
    "fact_ajustes_inventario": adjustments,
    "fact_compras": purchases,
    "fact_logistica_entregas": delivery,
    "fact_costos_mensual": costs,
    "fact_presupuesto_mensual": budget,
}


DAYS = "dias_hasta_devolucion"


def days_to_return(returned: DataFrame, sales: DataFrame) -> DataFrame:
    """Days between a sale and its return (left join: returns of unknown sales stay, with NULL).

    ``sales`` has one row per sale, so a sale that collects a large share of all
    returns is skew on the left side only; adaptive execution splits that side.
    """
    sold_on = sales.select("venta_id", F.col("fecha_venta").alias("_vendido"))
    joined = returned.drop(DAYS).join(sold_on, "venta_id", "left")
    return joined.withColumn(DAYS, F.datediff("fecha_devolucion", "_vendido")).drop("_vendido")


def derive(table: str, df: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Add a table's measures; returns also get their age when the sales table is there."""
    columns = MEASURES[table]() if table in MEASURES else {}
    out = df.withColumns(columns) if columns else df
    if table == "fact_devoluciones" and sales is not None:
        out = days_to_return(out, sales)
    return out
