"""Monthly gold products.

Each product has a *core* (grain, measures, ratios) and a published form with
dimension names attached.  Rollups of products, such as the executive KPIs,
start from the cores, or from published products, which have the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as fv
from tidemark.functions.columns import mean
from tidemark.operators.rollup import Lake, by_month, hits, monthly, summed, total, with_ratios
from tidemark.plans import dims

MES_TIENDA = [fv.MONTH, "tienda_id"]
SHARES = 32  # parts of a product's sales that are counted apart


def sales_by(lake: Lake, *grain: str, **measures: tuple[str, Column]) -> DataFrame:
    return summed(lake, "fact_ventas_cabecera", "mart_ventas_mensual", *grain, **measures)


# --- commercial --------------------------------------------------------------

def sales_core(lake: Lake) -> DataFrame:
    sales = monthly(
        lake["fact_ventas_cabecera"], "tienda_id", "ciudad_id", "canal_id",
        ventas_brutas=total("valor_bruto"),
        descuentos=total("descuento_total"),
        iva=total("iva_total"),
        ventas_sin_iva=total("base_neta_sin_iva"),
        ventas_totales=total("valor_total"),
        costo_total=total("costo_total"),
        margen_bruto=total("margen_bruto"),
        numero_ventas=lake.rows_of("fact_ventas_cabecera"),
        numero_lineas=total("numero_lineas"),
        ventas_con_campana=lake.rows_of("fact_ventas_cabecera", only=F.col("campana_id").isNotNull()),
    )
    return with_ratios(
        sales,
        margen_bruto_pct=("margen_bruto", "ventas_sin_iva"),
        ticket_promedio=("ventas_totales", "numero_ventas"),
        ticket_promedio_sin_iva=("ventas_sin_iva", "numero_ventas"),
        lineas_promedio_por_ticket=("numero_lineas", "numero_ventas"),
        descuento_pct=("descuentos", "ventas_brutas"),
        participacion_campana_pct=("ventas_con_campana", "numero_ventas"),
    )


def sales(lake: Lake) -> DataFrame:
    return dims.attach(dims.attach_store(sales_core(lake), lake), dims.city(lake), dims.channel(lake))


def _line_sums() -> dict[str, Column]:
    return dict(
        unidades_vendidas=total("cantidad"),
        ventas_linea_sin_iva=total("base_sin_iva"),
        ventas_linea_con_iva=total("valor_total_linea"),
        costo_total_linea=total("costo_total_linea"),
        margen_bruto_linea=total("margen_bruto_linea"),
    )


ARTICLE_SOLD = ["tienda_id", "ciudad_id", "canal_id", "categoria_id", "producto_id"]


def product_sales_core(lake: Lake) -> DataFrame:
    """Sums of lines by product and place, of which rollups read what they need."""
    return _with_prices(monthly(
        lake["fact_ventas_detalle"], *ARTICLE_SOLD,
        numero_ventas=F.count_distinct("venta_id"),
        lineas_vendidas=lake.rows_of("fact_ventas_detalle"),
        **_line_sums(),
    ))


def _with_prices(lines: DataFrame) -> DataFrame:
    return with_ratios(
        lines,
        precio_promedio_unitario_sin_iva=("ventas_linea_sin_iva", "unidades_vendidas"),
        precio_promedio_unitario_con_iva=("ventas_linea_con_iva", "unidades_vendidas"),
        margen_linea_pct=("margen_bruto_linea", "ventas_linea_sin_iva"),
    )


def _sold_by_product(lake: Lake) -> DataFrame:
    """``product_sales_core`` where all of its sums are wanted, lying by product.

    There are nearly as many groups as lines.  Lines are dealt by product and a share of its sales, so all lines of a sale
    meet and sales are counted where they are; the sums of shares are dealt by product, by which it meets its names
    without another shuffle.  A product held by a third of all lines is summed in ``SHARES`` places first.
    """
    if "fact_ventas_detalle" not in lake.keyed:  # distinct lines of shares do not add up
        return product_sales_core(lake)
    share = F.pmod(F.xxhash64("venta_id"), F.lit(SHARES))
    facts = lake["fact_ventas_detalle"].withColumns({"_parte": share, "_linea": F.col("detalle_venta_id").isNotNull()})
    parts = monthly(facts, *ARTICLE_SOLD, "_parte", dealt=["producto_id", "_parte"],
                    numero_ventas=F.count_distinct("venta_id"), lineas_vendidas=hits("_linea"), **_line_sums())
    return _with_prices(_added(parts.drop("_parte").repartition("producto_id"), *ARTICLE_SOLD))


def _added(parts: DataFrame, *grain: str) -> DataFrame:
    """Sums of parts of groups, added up; their types stay."""
    sums = [f for f in parts.schema.fields if f.name not in (fv.MONTH, *grain)]
    return parts.groupBy(fv.MONTH, *grain).agg(*[total(f.name).cast(f.dataType).alias(f.name) for f in sums])


def product_sales(lake: Lake) -> DataFrame:
    return dims.attach_product(
        _sold_by_product(lake), lake,
        lambda df: dims.attach(dims.attach_store(df, lake), dims.city(lake), dims.channel(lake)), dims.category(lake))


ARTICLE_RETURNED = ["tienda_id", "ciudad_id", "categoria_id", "producto_id", "motivo_devolucion_id"]


def _returned(lake: Lake) -> dict[str, Column]:
    return dict(
        devoluciones=lake.rows_of("fact_devoluciones"),
        unidades_devueltas=total("cantidad_devuelta"),
        valor_reintegrado=total("valor_reintegrado"),
        ventas_con_devolucion=F.count_distinct("venta_id"),
    )


def returns_measures(lake: Lake) -> DataFrame:
    return monthly(
        lake["fact_devoluciones"], *ARTICLE_RETURNED, **_returned(lake),
        lineas_con_devolucion=F.count_distinct("detalle_venta_id"),
        devoluciones_revision_calidad=hits("requiere_revision_calidad"),
        dias_promedio_hasta_devolucion=mean("dias_hasta_devolucion"),
    )


def _returned_apart(lake: Lake) -> DataFrame:
    """``returns_measures`` where all of them are wanted.

    Returned sales and returned lines are counted apart and added up: one grouping with two distinct counts would
    shuffle every row once for each of them and once more.
    """
    facts = lake["fact_devoluciones"]
    sums = monthly(
        facts, *ARTICLE_RETURNED, **_returned(lake),
        devoluciones_revision_calidad=hits("requiere_revision_calidad"),
        _dias=total("dias_hasta_devolucion"), _con_dias=F.count("dias_hasta_devolucion"),
    )
    lines = by_month(facts).select(fv.MONTH, *ARTICLE_RETURNED, "detalle_venta_id").distinct().groupBy(fv.MONTH, *ARTICLE_RETURNED).agg(
        F.count("detalle_venta_id").alias("lineas_con_devolucion"))
    added = _added(sums.unionByName(lines, allowMissingColumns=True), *ARTICLE_RETURNED)
    return with_ratios(added, dias_promedio_hasta_devolucion=("_dias", "_con_dias")).select(
        fv.MONTH, *ARTICLE_RETURNED, *_returned(lake), "lineas_con_devolucion", "devoluciones_revision_calidad",
        "dias_promedio_hasta_devolucion")


def returns_core(lake: Lake) -> DataFrame:
    """Returns against the sales of the month and place they came back in.

    Both sides are aggregated before they meet, so no sale is counted twice.
    """
    place = ["tienda_id", "ciudad_id"]
    article = [*place, "categoria_id", "producto_id"]
    store_sales = sales_by(
        lake, *place,
        numero_ventas=("numero_ventas", lake.rows_of("fact_ventas_cabecera")),
        ventas_totales=("ventas_totales", total("valor_total")),
        margen_bruto=("margen_bruto", total("margen_bruto")),
    )
    lines_sold = summed(
        lake, "fact_ventas_detalle", "mart_ventas_producto_mensual", *article, dealt=[fv.MONTH, *article],
        total_lineas_vendidas=("lineas_vendidas", lake.rows_of("fact_ventas_detalle")),
    )
    met = (
        _returned_apart(lake)
        .join(store_sales, [fv.MONTH, *place], "left")
        .join(lines_sold, [fv.MONTH, *article], "left")
        .withColumn("ventas_netas", F.col("ventas_totales") - F.col("valor_reintegrado"))
    )
    return with_ratios(
        met,
        tasa_devolucion_ticket=("ventas_con_devolucion", "numero_ventas"),
        tasa_devolucion_linea=("lineas_con_devolucion", "total_lineas_vendidas"),
        valor_devuelto_pct=("valor_reintegrado", "ventas_totales"),
        revision_calidad_pct=("devoluciones_revision_calidad", "devoluciones"),
    )


def returns(lake: Lake) -> DataFrame:
    return dims.attach_product(returns_core(lake), lake, lambda df: dims.attach(dims.attach_store(df, lake), dims.city(lake)),
                               dims.category(lake), dims.return_reason(lake))


def marketing_core(lake: Lake) -> DataFrame:
    """Campaign results; campaign attributes depend on its id, so they join after the rollup."""
    spend = monthly(
        lake["fact_marketing"], "campana_id", "ciudad_id", "canal_id", "medio_principal",
        gasto_marketing=total("gasto_marketing"),
        impresiones=total("impresiones"),
        clics=total("clics"),
        leads=total("leads"),
        conversiones_atribuidas=total("conversiones_atribuidas"),
        ventas_atribuidas_valor=total("ventas_atribuidas_valor"),
    )
    return with_ratios(
        spend,
        ctr=("clics", "impresiones"),
        cvr_lead=("conversiones_atribuidas", "leads"),
        cpc=("gasto_marketing", "clics"),
        cpl=("gasto_marketing", "leads"),
        cpa=("gasto_marketing", "conversiones_atribuidas"),
        roas=("ventas_atribuidas_valor", "gasto_marketing"),
    )


def marketing(lake: Lake) -> DataFrame:
    return dims.attach(marketing_core(lake), dims.campaign(lake).drop("activa"), dims.city(lake), dims.channel(lake))


# --- operations --------------------------------------------------------------

def inventory_core(lake: Lake) -> DataFrame:
    stock = monthly(
        lake["fact_inventario_mensual"], "tienda_id", "producto_id", "categoria_id",
        stock_inicial=total("stock_inicial"),
        entradas_compras=total("entradas_compras"),
        salidas_ventas=total("salidas_ventas"),
        ajuste_unidades=total("ajuste_unidades"),
        merma_unidades=total("merma_unidades"),
        stock_final=total("stock_final"),
        valor_inventario_costo=total("valor_inventario_costo"),
        cobertura_dias_promedio=mean("cobertura_dias"),
        productos_bajo_reorden=hits("alerta_reorden"),
        productos_bajo_stock_seguridad=hits("alerta_stock_seguridad"),
        stockout_count=hits(F.col("stock_final") <= 0),
        stock_promedio=mean("stock_promedio"),
    )
    return with_ratios(
        stock,
        rotacion_inventario=("salidas_ventas", "stock_promedio"),
        merma_pct=("merma_unidades", "stock_inicial"),
    )


def inventory(lake: Lake) -> DataFrame:
    return dims.attach(dims.attach_store(inventory_core(lake), lake), dims.product(lake), dims.category(lake))


def _bought(lake: Lake) -> DataFrame:
    """Purchases by month, store, supplier, product and reason, with the negotiated terms.

    Terms depend on (product, supplier) only, both in the grain, so they join the rollup instead of every purchase row.
    There are nearly as many groups as rows, which are dealt by product and supplier, so groups lie where their terms do.
    """
    state = F.col("estado_orden")
    facts = lake["fact_compras"].withColumns({"_recibida": state == "Recibida", "_abierta": state.isin("Pendiente", "Parcial")})
    bought = monthly(
        facts, "tienda_id", "proveedor_id", "producto_id", "categoria_id", "motivo_compra", dealt=["producto_id", "proveedor_id"],
        ordenes_compra=lake.rows_of("fact_compras"),
        cantidad_comprada=total("cantidad_comprada"),
        subtotal_compras=total("subtotal_sin_iva"),
        iva_compras=total("iva_valor"),
        compras_totales=total("valor_total_compra"),
        ordenes_recibidas=hits("_recibida"),
        ordenes_abiertas=hits("_abierta"),
    )
    return bought.join(dims.negotiated_terms(lake), ["producto_id", "proveedor_id"], "left")


def _against_terms(bought: DataFrame, lake: Lake) -> DataFrame:
    """Supplier facts and figures against the terms.

    The averages over purchase rows are unchanged: inside a group their operand is constant.
    """
    terms = (
        bought.join(dims.supplier(lake), "proveedor_id", "left")
        .withColumns({
            "costo_negociado_promedio": F.col("costo_negociado").cast("double"),
            "lead_time_promedio_proveedor":
                F.coalesce("lead_time_dias", "lead_time_promedio_dias").cast("double"),
            "calificacion_servicio_promedio": F.col("calificacion_servicio").cast("double"),
        })
        .drop("costo_negociado", "lead_time_dias", "lead_time_promedio_dias", "calificacion_servicio")
    )
    priced = with_ratios(
        terms,
        costo_unitario_promedio_con_iva=("compras_totales", "cantidad_comprada"),
        costo_sin_iva_promedio=("subtotal_compras", "cantidad_comprada"),
        ordenes_recibidas_pct=("ordenes_recibidas", "ordenes_compra"),
    ).withColumn("variacion_vs_costo_negociado",
                 F.col("costo_sin_iva_promedio") - F.col("costo_negociado_promedio"))
    return with_ratios(
        priced, variacion_vs_costo_negociado_pct=("variacion_vs_costo_negociado", "costo_negociado_promedio"))


def purchases_core(lake: Lake) -> DataFrame:
    """Purchases against negotiated terms."""
    return _against_terms(_bought(lake), lake)


def purchases(lake: Lake) -> DataFrame:
    return dims.attach_product(_bought(lake), lake, lambda df: dims.attach_store(_against_terms(df, lake), lake), dims.category(lake))


def logistics_core(lake: Lake) -> DataFrame:
    shipped = monthly(
        lake["fact_logistica_entregas"],
        "tienda_id", "ciudad_origen_id", "ciudad_destino_id", "canal_id", "transportista_id",
        entregas=lake.rows_of("fact_logistica_entregas"),
        entregas_a_tiempo=hits("entrega_a_tiempo"),
        entregas_tardias=hits("entrega_tardia"),
        entregas_fallidas=hits("entrega_fallida"),
        entregas_canceladas=hits("entrega_cancelada"),
        entregas_pendientes=hits("entrega_pendiente"),
        dias_prometidos_promedio=mean("dias_prometidos"),
        dias_reales_promedio=mean("dias_reales_entrega"),
        dias_retraso_promedio=mean("dias_retraso"),
        peso_total_kg=total("peso_estimado_kg"),
        costo_envio_total=total("costo_envio"),
    )
    sold = sales_by(lake, "tienda_id", "canal_id", ventas_totales_asociadas=("ventas_totales", total("valor_total")))
    return with_ratios(
        shipped.join(sold, [*MES_TIENDA, "canal_id"], "left"),
        entregas_a_tiempo_pct=("entregas_a_tiempo", "entregas"),
        entregas_pendientes_pct=("entregas_pendientes", "entregas"),
        costo_envio_promedio=("costo_envio_total", "entregas"),
        costo_por_kg=("costo_envio_total", "peso_total_kg"),
        costo_logistico_sobre_venta_pct=("costo_envio_total", "ventas_totales_asociadas"),
    )


def logistics(lake: Lake) -> DataFrame:
    return dims.attach(dims.attach_store(logistics_core(lake), lake), dims.channel(lake), dims.carrier(lake),
                       dims.city_as(lake, "origen"), dims.city_as(lake, "destino"))


# --- finance -----------------------------------------------------------------

def store_month_sales(lake: Lake) -> DataFrame:
    return sales_by(
        lake, "tienda_id",
        ventas_totales=("ventas_totales", total("valor_total")),
        ventas_sin_iva=("ventas_sin_iva", total("base_neta_sin_iva")),
        margen_bruto=("margen_bruto", total("margen_bruto")),
        numero_ventas=("numero_ventas", lake.rows_of("fact_ventas_cabecera")),
    )


def finance_core(lake: Lake) -> DataFrame:
    """Budget and cost, whichever exists, next to sales."""
    planned = monthly(lake["fact_presupuesto_mensual"], "tienda_id",
                      presupuesto=total("monto_presupuesto"), ejecutado=total("monto_ejecutado"))
    spent = monthly(lake["fact_costos_mensual"], "tienda_id",
                    costos_presupuestados=total("monto_presupuestado"), costos_reales=total("monto_real"))
    books = planned.join(spent, MES_TIENDA, "full").join(store_month_sales(lake), MES_TIENDA, "left")
    gaps = books.withColumns({
        "variacion_presupuesto": F.col("ejecutado") - F.col("presupuesto"),
        "variacion_costos": F.col("costos_reales") - F.col("costos_presupuestados"),
        "margen_despues_costos": F.col("margen_bruto") - F.col("costos_reales"),
    })
    return with_ratios(
        gaps,
        variacion_presupuesto_pct=("variacion_presupuesto", "presupuesto"),
        ejecucion_presupuesto_pct=("ejecutado", "presupuesto"),
        variacion_costos_pct=("variacion_costos", "costos_presupuestados"),
        costos_sobre_ventas_pct=("costos_reales", "ventas_totales"),
        margen_despues_costos_pct=("margen_despues_costos", "ventas_sin_iva"),
    )


def finance(lake: Lake) -> DataFrame:
    return dims.attach_store(finance_core(lake), lake)


def targets_core(lake: Lake) -> DataFrame:
    """Targets against what was sold, returned and delivered; a hit is NULL while unknown."""
    goals = monthly(
        lake["fact_objetivos_mensuales"], "tienda_id",
        meta_ventas=total("meta_ventas"),
        meta_tickets=total("meta_tickets"),
        meta_margen_bruto=total("meta_margen_bruto"),
        meta_tasa_devolucion=mean("meta_tasa_devolucion"),
        meta_entregas=total("meta_entregas"),
    )
    returned = monthly(lake["fact_devoluciones"], "tienda_id", devoluciones=lake.rows_of("fact_devoluciones"))
    delivered = monthly(lake["fact_logistica_entregas"], "tienda_id",
                        entregas=lake.rows_of("fact_logistica_entregas"))
    actual = goals
    for side in (store_month_sales(lake), returned, delivered):
        actual = actual.join(side, MES_TIENDA, "left")
    rated = with_ratios(
        actual,
        cumplimiento_ventas_pct=("ventas_totales", "meta_ventas"),
        cumplimiento_tickets_pct=("numero_ventas", "meta_tickets"),
        cumplimiento_margen_pct=("margen_bruto", "meta_margen_bruto"),
        tasa_devolucion_ticket=("devoluciones", "numero_ventas"),
        entregas_vs_meta=("entregas", "meta_entregas"),
    )
    compared = {"ventas": ("ventas_totales", "meta_ventas"), "tickets": ("numero_ventas", "meta_tickets"),
                "margen": ("margen_bruto", "meta_margen_bruto")}
    hit_or_gap = {f"brecha_{k}": F.col(real) - F.col(goal) for k, (real, goal) in compared.items()}
    hit_or_gap |= {f"cumple_meta_{k}": F.col(f"cumplimiento_{k}_pct") >= 1 for k in compared}
    return with_ratios(rated.withColumns(hit_or_gap),
                       tasa_devolucion_vs_meta=("tasa_devolucion_ticket", "meta_tasa_devolucion"))


def targets(lake: Lake) -> DataFrame:
    return dims.attach_store(targets_core(lake), lake)


# --- executive KPIs ----------------------------------------------------------

def _sums(*columns: str) -> list[Column]:
    return [total(c).alias(c) for c in columns]


# what each product contributes to a month; a function, as columns need a session
def kpi_measures() -> dict[str, list[Column]]:
    return {
        "mart_ventas_mensual": _sums("ventas_totales", "ventas_sin_iva", "margen_bruto", "numero_ventas"),
        "mart_ventas_producto_mensual": _sums("unidades_vendidas"),
        "mart_devoluciones_mensual": _sums("devoluciones", "valor_reintegrado"),
        "mart_inventario_mensual": [mean("cobertura_dias_promedio").alias("cobertura_dias_promedio"), *_sums("productos_bajo_reorden")],
        "mart_logistica_mensual": _sums("entregas", "entregas_a_tiempo", "costo_envio_total"),
        "mart_marketing_mensual": _sums("gasto_marketing", "ventas_atribuidas_valor"),
        "mart_finanzas_mensual": _sums("presupuesto", "ejecutado", "costos_reales"),
        "mart_objetivos_mensual": [*_sums("meta_ventas"), total("ventas_totales").alias("ventas_objetivo_totales")],
    }


def kpis(products: Mapping[str, DataFrame]) -> DataFrame:
    """One row per month with sales; the other products join where they have that month.

    Coverage is the plain average over inventory rows of the product, as users
    of the lake know it, not an average weighted by stock.
    """
    board = None
    for name, measures in kpi_measures().items():
        months = products[name].groupBy(fv.MONTH).agg(*measures)
        board = months if board is None else board.join(months, fv.MONTH, "left")
    refunded = F.coalesce(F.col("valor_reintegrado"), F.lit(0))
    return with_ratios(
        board.withColumn("ventas_netas", F.col("ventas_totales") - refunded),
        margen_bruto_pct=("margen_bruto", "ventas_sin_iva"),
        ticket_promedio=("ventas_totales", "numero_ventas"),
        tasa_devolucion=("devoluciones", "numero_ventas"),
        valor_reintegrado_pct=("valor_reintegrado", "ventas_totales"),
        entregas_a_tiempo_pct=("entregas_a_tiempo", "entregas"),
        costo_logistico_sobre_venta_pct=("costo_envio_total", "ventas_totales"),
        marketing_roas=("ventas_atribuidas_valor", "gasto_marketing"),
        ejecucion_presupuesto_pct=("ejecutado", "presupuesto"),
        costos_sobre_ventas_pct=("costos_reales", "ventas_totales"),
        cumplimiento_ventas_pct=("ventas_objetivo_totales", "meta_ventas"),
    )


PRODUCTS: dict[str, Callable[[Lake], DataFrame]] = {
    "mart_ventas_mensual": sales,
    "mart_ventas_producto_mensual": product_sales,
    "mart_devoluciones_mensual": returns,
    "mart_marketing_mensual": marketing,
    "mart_inventario_mensual": inventory,
    "mart_compras_proveedores_mensual": purchases,
    "mart_logistica_mensual": logistics,
    "mart_finanzas_mensual": finance,
    "mart_objetivos_mensual": targets,
}

CORES: dict[str, Callable[[Lake], DataFrame]] = {
    "mart_ventas_mensual": sales_core,
    "mart_ventas_producto_mensual": product_sales_core,
    # the KPIs read only counts and refunds of returns, which need no sales base
    "mart_devoluciones_mensual": returns_measures,
    "mart_marketing_mensual": marketing_core,
    "mart_inventario_mensual": inventory_core,
    "mart_logistica_mensual": logistics_core,
    "mart_finanzas_mensual": finance_core,
    "mart_objetivos_mensual": targets_core,
}
