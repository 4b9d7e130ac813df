"""The retail lake's silver tables, as views over the shared test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from suite.registry import table
from tidemark import fixed_values as fv
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.measures import derive
from tidemark.operators.rollup import Lake
from tidemark.workspace import stage

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_NEWEST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def text(c: str) -> Column:
    return F.col(c).cast("string")


def month(c: str) -> Column:
    return F.date_format(c, "yyyy-MM")


def newest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (order, line number), dealt out and sorted by order: what joins or groups them by order needs no further shuffle or sort."""
    return latest_by_key(table(spark, sf, "lineitem").repartition("l_orderkey"), LINE_KEY, LINE_NEWEST)


def with_part(spark: SparkSession, sf: str, newest: DataFrame) -> DataFrame:
    """Lines with what their price and product depend on, as the tables give it; ``valued`` derives the rest."""
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return newest.join(part, F.col("l_partkey") == F.col("p_partkey"))


def valued(rows: DataFrame) -> DataFrame:
    """Lines, priced in exact cents, with their texts; derived where they are used, so that neither is shuffled or staged."""
    share = {c: F.col(c).cast("decimal(4,2)") for c in ("l_discount", "l_tax")}
    return (
        rows
        .withColumns({"bruto": money("l_extendedprice"), "cantidad": F.col("l_quantity").cast("bigint")})
        .withColumn("descuento_valor", money(F.col("bruto") * share["l_discount"]))
        .withColumn("base_sin_iva", money(F.col("bruto") - F.col("descuento_valor")))
        .withColumn("iva_valor", money(F.col("base_sin_iva") * share["l_tax"]))
        .withColumns({
            "valor_total_linea": money(F.col("base_sin_iva") + F.col("iva_valor")),
            "costo_total_linea": money(F.col("cantidad").cast("decimal(8,0)") * F.col("p_retailprice").cast("decimal(9,2)")),
        })
        .withColumns({
            "margen_bruto_linea": money(F.col("base_sin_iva") - F.col("costo_total_linea")),
            "detalle_venta_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
            "producto_id": text("l_partkey"),
            "proveedor_id": text("l_suppkey"),
            "mes_envio": month("l_shipdate"),
            "fecha_envio": F.to_date("l_shipdate"),
        })
        .withColumnRenamed("p_type", "categoria_id")
    )


def orders_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with store and city, without the texts that ``named`` derives."""
    who = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return table(spark, sf, "orders").join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("c_mktsegment").alias("tienda_id"), text("c_nationkey").alias("ciudad_id"),
        F.col("o_orderpriority").alias("canal_id"), F.to_date("o_orderdate").alias("fecha_venta"),
    )


def named(orders_df: DataFrame) -> DataFrame:
    return orders_df.withColumns({"venta_id": text("o_orderkey"), "cliente_id": text("o_custkey"), "mes_carga": month("fecha_venta")})


# what is kept of the order of a line
OF_ORDER = ["o_orderkey", "tienda_id", "ciudad_id", "canal_id", "fecha_venta"]


def lines_of_orders(spark: SparkSession, sf: str, orders_df: DataFrame) -> DataFrame:
    """Lines with the store, city, channel and day of their order, which they meet where they lie by order."""
    return newest_lines(spark, sf).join(orders_df.select(*OF_ORDER), F.col("l_orderkey") == F.col("o_orderkey"))


def placed(rows: DataFrame) -> DataFrame:
    return valued(rows).withColumns({"venta_id": text("l_orderkey"), "mes_carga": month("fecha_venta")})


# --- facts ---------------------------------------------------------------------

def sales_header(lines_df: DataFrame, orders_df: DataFrame) -> DataFrame:
    """Orders with at least one line; amounts are summed per order before the join."""
    sums = {"valor_bruto": "bruto", "descuento_total": "descuento_valor", "iva_total": "iva_valor",
            "valor_total": "valor_total_linea", "costo_total": "costo_total_linea",
            "margen_bruto": "margen_bruto_linea"}
    per_order = lines_df.groupBy("l_orderkey").agg(
        *[money(F.sum(c)).alias(name) for name, c in sums.items()], F.count("*").alias("numero_lineas"))
    return named(per_order.join(orders_df, F.col("l_orderkey") == F.col("o_orderkey"))).select(
        "venta_id", F.date_format("fecha_venta", "yyyyMMdd").cast("bigint").alias("fecha_id"), "fecha_venta",
        "mes_carga", "tienda_id", "ciudad_id", "cliente_id", "canal_id",
        F.nullif("o_orderstatus", F.lit("O")).alias("campana_id"), *sums, "numero_lineas")


def sales_line(placed: DataFrame) -> DataFrame:
    return placed.select(
        "detalle_venta_id", "venta_id", "mes_carga", "tienda_id", "ciudad_id", "canal_id", "categoria_id",
        "producto_id", "cantidad", "descuento_valor", "base_sin_iva", "iva_valor", "valor_total_linea",
        "costo_total_linea", "margen_bruto_linea")


def returns(placed: DataFrame) -> DataFrame:
    back = placed.filter("l_returnflag = 'R'")
    state = F.when(F.col("l_linestatus") == "F", "Aprobada").when(F.col("l_tax") == 0, "Rechazada") \
        .otherwise("En revision")
    return back.select(
        F.concat(F.lit("D"), "detalle_venta_id").alias("devolucion_id"), "venta_id", "detalle_venta_id",
        F.col("mes_envio").alias("mes_carga"), "tienda_id", "ciudad_id", "categoria_id", "producto_id",
        F.col("l_linestatus").alias("motivo_devolucion_id"), F.col("fecha_envio").alias("fecha_devolucion"),
        state.alias("estado_devolucion"), F.col("cantidad").alias("cantidad_devuelta"),
        F.col("valor_total_linea").alias("valor_reintegrado"),
        (F.col("l_linestatus") == "F").alias("requiere_revision_calidad"))


def purchases(placed: DataFrame) -> DataFrame:
    state = F.when(F.col("l_linestatus") == "F", "Recibida").when(F.col("l_returnflag") == "R", "Parcial") \
        .otherwise("Pendiente")
    return placed.select(
        F.col("detalle_venta_id").alias("orden_compra_id"), F.col("mes_envio").alias("mes_carga"), "tienda_id",
        "producto_id", "proveedor_id", "categoria_id", F.col("l_returnflag").alias("motivo_compra"),
        state.alias("estado_orden"), F.col("cantidad").alias("cantidad_comprada"),
        F.col("base_sin_iva").alias("subtotal_sin_iva"), "iva_valor",
        F.col("valor_total_linea").alias("valor_total_compra"))


def with_origin(rows: DataFrame, supplier: DataFrame) -> DataFrame:
    origin = supplier.select(F.col("s_suppkey"), text("s_nationkey").alias("ciudad_origen_id"))
    return rows.join(origin, F.col("l_suppkey") == F.col("s_suppkey"))


def deliveries(placed: DataFrame) -> DataFrame:
    delivered = F.when(F.col("l_linestatus") == "F", F.col("fecha_envio"))
    promised = F.substring("canal_id", 1, 1).cast("bigint") * 30
    took = F.datediff(delivered, "fecha_venta").cast("bigint")
    back = F.col("l_returnflag") == "R"
    state = (
        F.when(back & delivered.isNull(), "Cancelado en ruta").when(back, "Intento fallido")
        .when(took > promised, "Entregado tarde").when(delivered.isNotNull(), "Entregado")
    )
    return placed.select(
        F.concat(F.lit("E"), "detalle_venta_id").alias("entrega_id"), "venta_id", "mes_carga", "tienda_id",
        "ciudad_origen_id", F.col("ciudad_id").alias("ciudad_destino_id"), "canal_id",
        (F.col("l_suppkey") % 5).cast("string").alias("transportista_id"),
        F.when(F.col("l_partkey") % 3 == 0, (F.col("l_partkey") % 50).cast("string")).alias("empleado_repartidor_id"),
        state.alias("estado_entrega"), delivered.alias("fecha_entrega"), promised.alias("dias_prometidos"),
        took.alias("dias_reales_entrega"), (took - promised).alias("dias_retraso"),
        F.col("l_quantity").alias("peso_estimado_kg"),
        money(F.col("cantidad").cast("decimal(8,0)") * F.lit("0.50").cast("decimal(3,2)")).alias("costo_envio"))


MOVEMENTS = ["entradas_compras", "salidas_ventas", "ajuste_unidades", "merma_unidades"]
OF_PART = ["categoria_id", "p_size", "p_retailprice"]


def movements(lines_df: DataFrame, *of_part: str) -> DataFrame:
    """Units moved by month, store and product."""
    back, units = F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint")
    return lines_df.groupBy(month("l_shipdate").alias("mes_carga"), "tienda_id", text("l_partkey").alias("producto_id"), *of_part).agg(
        F.coalesce(F.sum(F.when(back, units)), F.lit(0)).alias("entradas_compras"),
        F.coalesce(F.sum(F.when(~back, units)), F.lit(0)).alias("salidas_ventas"),
        F.count_if(F.col("l_discount") == 0).alias("ajuste_unidades"),
        F.count_if(F.col("l_tax") == 0).alias("merma_unidades"))


def movements_of_parts(spark: SparkSession, sf: str, lines_df: DataFrame) -> DataFrame:
    """The same of lines that have not met their part, which their sums meet: a product held by a third of all lines is a row a
    month and store there, and what groups or joins by product afterwards needs no further shuffle.  A part that is there
    several times counts as often."""
    part = table(spark, sf, "part").select(text("p_partkey").alias("_parte"), F.col("p_type").alias("categoria_id"), "p_size", "p_retailprice")
    told = part.repartition("_parte").groupBy(*part.columns).agg(F.count("*").alias("_veces"))
    met = movements(lines_df).join(told, F.col("producto_id") == F.col("_parte"))
    return met.select("mes_carga", "tienda_id", "producto_id", *OF_PART, *[(F.col(c) * F.col("_veces")).alias(c) for c in MOVEMENTS])


def inventory(moved: DataFrame) -> DataFrame:
    """Month x store x product movements and stock."""
    size = F.col("p_size").cast("bigint")
    closing = F.col("stock_inicial") + F.col("entradas_compras") - F.col("salidas_ventas") \
        + F.col("ajuste_unidades") - F.col("merma_unidades")
    return (
        moved.withColumn("stock_inicial", size * 10)
        .withColumn("stock_final", closing)
        .withColumns({
            "punto_reorden": size * 9, "stock_seguridad": size * 8, "cobertura_dias": size,
            "valor_inventario_costo":
                money(F.col("stock_final").cast("decimal(9,0)") * F.col("p_retailprice").cast("decimal(9,2)")),
        })
        .drop("p_size", "p_retailprice")
    )


def adjustments(lines_df: DataFrame) -> DataFrame:
    return lines_df.select(F.concat(F.lit("A"), "detalle_venta_id").alias("ajuste_id"),
                           F.when(F.col("l_tax") == 0, F.col("cantidad")).otherwise(0).alias("merma_unidades"))


def marketing(events: DataFrame) -> DataFrame:
    """Events per day and user group, as campaign results (months moved into the order period)."""
    group = F.col("user_id") % 8
    day = F.add_months(F.to_date("ts"), -300)

    def seen(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    def worth(kind: str) -> Column:
        cents = F.when(F.col("event_type") == kind, money("value"))
        return money(F.coalesce(F.sum(cents), F.lit(0)))

    per_day = events.groupBy(day.alias("dia"), group.alias("grupo")).agg(
        worth("error").alias("gasto_marketing"), seen("view").alias("impresiones"), seen("click").alias("clics"),
        seen("signup").alias("leads"), seen("purchase").alias("conversiones_atribuidas"),
        worth("purchase").alias("ventas_atribuidas_valor"))
    return per_day.select(
        F.concat_ws("-", F.date_format("dia", "yyyyMMdd"), "grupo").alias("marketing_id"),
        month("dia").alias("mes_carga"),
        F.element_at(F.array(F.lit("F"), F.lit("P"), F.lit("X")), (F.col("grupo") % 3 + 1).cast("int")).alias("campana_id"),
        text("grupo").alias("ciudad_id"),
        F.when(F.col("grupo") < 4, "1-URGENT").otherwise("5-LOW").alias("canal_id"),
        F.when(F.col("grupo") % 2 == 0, "Digital").otherwise("Tradicional").alias("medio_principal"),
        "gasto_marketing", "impresiones", "clics", "leads", "conversiones_atribuidas", "ventas_atribuidas_valor")


def costs(placed: DataFrame) -> DataFrame:
    spent = placed.groupBy(F.col("mes_envio").alias("mes_carga"), "tienda_id").agg(
        money(F.sum("base_sin_iva")).alias("monto_presupuestado"), money(F.sum("costo_total_linea")).alias("monto_real"))
    return spent.withColumn("costo_id", F.concat_ws("-", "mes_carga", "tienda_id"))


def budget(orders_df: DataFrame) -> DataFrame:
    done = F.when(F.col("o_orderstatus") == "F", money("o_totalprice"))
    planned = orders_df.groupBy("mes_carga", "tienda_id").agg(
        money(F.sum(money("o_totalprice"))).alias("monto_presupuesto"), money(F.sum(done)).alias("monto_ejecutado"))
    return planned.withColumn("presupuesto_id", F.concat_ws("-", "mes_carga", "tienda_id"))


def targets(orders_df: DataFrame) -> DataFrame:
    sums = orders_df.groupBy("mes_carga", "tienda_id").agg(
        money(F.sum(money("o_totalprice"))).alias("vendido"), F.count("*").alias("pedidos"))

    def part_of(share: str) -> Column:
        return money(F.col("vendido") * F.lit(share).cast("decimal(3,2)"))

    return sums.select(
        F.concat_ws("-", "mes_carga", "tienda_id").alias("objetivo_id"), "mes_carga", "tienda_id",
        part_of("0.95").alias("meta_ventas"), (F.col("pedidos") - 1).alias("meta_tickets"),
        part_of("0.10").alias("meta_margen_bruto"),
        F.lit("0.2500").cast("decimal(10,4)").alias("meta_tasa_devolucion"),
        (F.col("pedidos") * 3).alias("meta_entregas"))


def control_totals(orders_df: DataFrame) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return orders_df.groupBy("mes_carga").agg(
        F.count("*").alias("ventas"), money(F.sum(money("o_totalprice"))).alias("valor_total"),
        money(F.sum(F.when(F.col("o_orderstatus") == "P", money("o_totalprice")))).alias("margen_bruto"),
        F.count_if(done).alias("devoluciones"),
        money(F.sum(F.when(done, money("o_totalprice")))).alias("valor_reintegrado"))


# --- dimensions ------------------------------------------------------------------

def cities(spark: SparkSession, sf: str) -> DataFrame:
    region = table(spark, sf, "region")
    return table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        text("n_nationkey").alias("ciudad_id"), F.col("n_name").alias("ciudad"),
        F.concat(F.lit("Depto "), text("n_regionkey")).alias("departamento"), F.col("r_name").alias("region"))


def stores(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("tienda_id")).agg(
        F.min("c_nationkey").cast("string").alias("ciudad_id"),
        F.initcap(F.first("c_mktsegment")).alias("nombre_tienda"), F.lit("Sede").alias("tipo_sede"),
        F.lit("Activa").alias("estado_sede"))


def channels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderpriority").alias("canal_id")).distinct().select(
        "canal_id", F.substring("canal_id", 3, 50).alias("canal"), F.substring("canal_id", 1, 1).alias("tipo_canal"),
        F.lower("canal_id").alias("descripcion"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        text("p_partkey").alias("producto_id"), F.col("p_type").alias("categoria_id"),
        F.concat(F.lit("SKU"), text("p_partkey")).alias("sku"), F.col("p_name").alias("nombre_producto"),
        F.col("p_brand").alias("marca"), F.col("p_type").alias("especie"), F.lit("und").alias("unidad_medida"),
        F.when(F.col("p_size") > 25, "Alta").otherwise("Baja").alias("nivel_rotacion"),
        money("p_retailprice").alias("precio_lista"),
        money(F.col("p_size")).alias("costo_estandar"))


def categories(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("categoria_id")).agg(
        F.initcap(F.first("p_type")).alias("categoria"), F.lit("Familia").alias("familia"),
        F.min("p_brand").alias("especie_principal"), F.max("p_brand").alias("descripcion"))


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        text("s_suppkey").alias("proveedor_id"), text("s_nationkey").alias("ciudad_id"),
        F.col("s_name").alias("proveedor"),
        F.when(F.col("s_suppkey") % 2 == 0, "Local").otherwise("Externo").alias("tipo_proveedor"),
        F.concat(F.lit("Linea "), (F.col("s_suppkey") % 7).cast("string")).alias("especialidad"),
        F.lit("Activo").alias("estado_proveedor"), (F.col("s_suppkey") % 10 + 5).alias("lead_time_promedio_dias"),
        (F.col("s_suppkey") % 5).cast("decimal(10,4)").alias("calificacion_servicio"))


def terms(lines_df: DataFrame) -> DataFrame:
    """Supplier terms: known for even suppliers only, so that lookups also miss."""
    return lines_df.filter("l_suppkey % 2 = 0").groupBy("producto_id", "proveedor_id").agg(
        F.min("bruto").alias("costo_negociado"),
        F.nullif((F.min("l_linenumber") * 3).cast("bigint"), F.lit(3)).alias("lead_time_dias"))


def carriers(spark: SparkSession, sf: str) -> DataFrame:
    number = (F.col("s_suppkey") % 5).cast("string")
    return table(spark, sf, "supplier").select(number.alias("transportista_id")).distinct().select(
        "transportista_id", F.concat(F.lit("Carrier "), "transportista_id").alias("transportista"),
        F.lit("Terrestre").alias("tipo_transportista"), F.lit("Nacional").alias("cobertura"))


def reasons(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("motivo_devolucion_id")).distinct().select(
        "motivo_devolucion_id", F.concat(F.lit("Motivo "), "motivo_devolucion_id").alias("motivo_devolucion"),
        F.lit("Tienda").alias("responsable_principal"), F.lit("Media").alias("severidad"))


def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderstatus").alias("campana_id")).distinct().select(
        "campana_id", F.concat(F.lit("Campana "), "campana_id").alias("campana"), F.lit("Digital").alias("tipo_campana"),
        F.lit("todas").alias("categorias_objetivo"), F.lit("todos").alias("canales_objetivo"),
        (F.col("campana_id") == "F").alias("activa"))


def dates(orders_df: DataFrame) -> DataFrame:
    """Order days; the first of a month is a holiday, but every day carries a holiday name."""
    day = orders_df.select("fecha_venta").distinct()
    return day.select(
        F.date_format("fecha_venta", "yyyyMMdd").cast("bigint").alias("fecha_id"),
        (F.dayofmonth("fecha_venta") == 1).alias("es_festivo_colombia"),
        F.concat(F.lit("Festivo "), F.date_format("fecha_venta", "MM")).alias("festivo_nombre"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(text("c_custkey").alias("cliente_id"),
                                               text("c_nationkey").alias("ciudad_id"))


def employees(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as staff; every seventh has a blank store."""
    return table(spark, sf, "customer").select(
        text("c_custkey").alias("empleado_id"),
        F.when(F.col("c_custkey") % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_mktsegment")).alias("tienda_id"),
        text("c_nationkey").alias("area_id"))


# what a placed line is derived from
STAGED = """l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus
l_shipdate p_type p_size p_retailprice tienda_id ciudad_id canal_id fecha_venta""".split()


# --- the lake ----------------------------------------------------------------------

def base_lake(spark: SparkSession, sf: str, *, staged: str = "") -> Lake:
    """Silver inputs by name, before derivation.

    ``staged`` names what a job reads more than once and therefore writes once: "lines"
    (deduplicated, with their order and part; what is derived from these columns is derived by each reader), "sales"
    (summed from them), "orders" (with their customer's store and city); the alternative is to deduplicate and
    join the largest table again for every use.  Dimensions that are groupings of a
    larger table are always written, so that joins know their true size.
    """
    memo: dict[str, DataFrame] = {}

    def once(name: str, build) -> DataFrame:
        if name not in memo:
            memo[name] = build()
        return memo[name]

    def order_rows() -> DataFrame:
        def build():
            rows = orders_by_customer(spark, sf)
            return stage(rows, "orders") if "orders" in staged else rows
        return once("orders", build)

    def order() -> DataFrame:
        return once("named", lambda: named(order_rows()))

    def placed_rows() -> DataFrame:
        def build():
            rows = with_part(spark, sf, lines_of_orders(spark, sf, order_rows())).select(*STAGED)
            return stage(rows, "lines") if "lines" in staged else rows
        return once("placed rows", build)

    def placed_lines() -> DataFrame:
        return once("placed", lambda: placed(placed_rows()))

    def line_rows() -> DataFrame:
        return placed_rows() if "lines" in staged else once("lines", lambda: with_part(spark, sf, newest_lines(spark, sf)))

    def any_lines() -> DataFrame:
        return placed_lines() if "lines" in staged else valued(line_rows())

    def header() -> DataFrame:
        rows = line_rows()
        # staged lines lie by product: no two of an order would be summed before a shuffle, so the rows go, which are narrower than sums
        dealt = rows.repartition("l_orderkey") if "lines" in staged else rows
        sales = sales_header(valued(dealt), order_rows())
        return stage(sales, "sales") if "sales" in staged else sales

    def moved() -> DataFrame:
        if "lines" in staged:
            return movements(placed_lines(), *OF_PART)
        return movements_of_parts(spark, sf, lines_of_orders(spark, sf, order_rows()))

    return Lake({
        "dim_fecha": lambda: dates(order()),
        "dim_ciudad": lambda: stage(cities(spark, sf), "dim_ciudad"),
        "dim_tienda": lambda: stage(stores(spark, sf), "dim_tienda"),
        "dim_categoria_producto": lambda: stage(categories(spark, sf), "dim_categoria_producto"),
        "dim_producto": lambda: products(spark, sf),
        "dim_proveedor": lambda: suppliers(spark, sf),
        "bridge_producto_proveedor": lambda: terms(any_lines()),
        "dim_cliente": lambda: customers(spark, sf),
        "dim_canal_venta": lambda: stage(channels(spark, sf), "dim_canal_venta"),
        "dim_campana_marketing": lambda: stage(campaigns(spark, sf), "dim_campana_marketing"),
        "dim_transportista": lambda: stage(carriers(spark, sf), "dim_transportista"),
        "dim_motivo_devolucion": lambda: stage(reasons(spark, sf), "dim_motivo_devolucion"),
        "fact_ventas_cabecera": header,
        "fact_ventas_detalle": lambda: sales_line(placed_lines()),
        "fact_devoluciones": lambda: returns(placed_lines()),
        "fact_marketing": lambda: marketing(table(spark, sf, "events")),
        "fact_inventario_mensual": lambda: inventory(moved()),
        "fact_ajustes_inventario": lambda: adjustments(any_lines()),
        "fact_compras": lambda: purchases(placed_lines()),
        "fact_logistica_entregas": lambda: deliveries(placed(with_origin(placed_rows(), table(spark, sf, "supplier")))),
        "fact_costos_mensual": lambda: costs(placed_lines()),
        "fact_presupuesto_mensual": lambda: budget(order()),
        "fact_objetivos_mensuales": lambda: targets(order()),
        "resumen_mensual_validacion": lambda: control_totals(order()),
    })


# tables built by a grouping on their key or from rows whose key is unique by construction
KEYED = ("fact_ventas_cabecera", "fact_ventas_detalle", "fact_devoluciones", "fact_compras",
         "fact_logistica_entregas", "fact_marketing")


def silver_lake(spark: SparkSession, sf: str, *, staged: str = "") -> Lake:
    """The lake after derivation."""
    base = base_lake(spark, sf, staged=staged)

    def derived(name: str):
        def build():
            sales = base["fact_ventas_cabecera"] if name == "fact_devoluciones" else None
            return derive(name, base[name], sales)
        return build

    return Lake({name: derived(name) for name in base}, keyed=KEYED)
