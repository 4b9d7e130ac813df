"""Fixed values of the retail lake's data contract.

Everything in this module is a *fixed value*: names, lists and texts which the
lake's files and consumers already agree on and which results must reproduce.
There is no logic here.
"""

# --- technical columns -------------------------------------------------------
AREA = "_tm_area"
SOURCE_YEAR = "_tm_source_year"
SOURCE_MONTH = "_tm_source_month"
SOURCE_PATH = "_tm_source_path"
SOURCE_FILE = "_tm_source_file_name"
LOAD_MODE = "_tm_load_mode"
INGESTED_AT = "_tm_ingestion_ts"
RECORD_HASH = "_tm_record_hash"
SILVER_DOMAIN = "_tm_silver_domain"
SILVER_LAYER = "_tm_silver_layer"
SILVER_STEP = "_tm_silver_step"
SILVER_AT = "_tm_silver_processed_ts"
GOLD_LAYER = "_tm_gold_layer"
GOLD_AT = "_tm_gold_processed_ts"
MONTH = "mes_carga"

# --- domains, steps, statuses ------------------------------------------------
DOMAINS = ("shared", "comercial", "finanzas", "operaciones", "gobierno")
STEPS = (
    "schema_standardization",
    "null_corrections",
    "domain_normalization",
    "business_derivations",
)
SUCCESS, FAILED, NO_DATA = "SUCCESS", "FAILED", "NO_DATA"
ARCHIVED = "SUCCESS"  # what the load log says of a file that was archived
NO_TABLES, NO_FILES = "__NO_TABLES__", "__NO_FILES__"

# --- files -------------------------------------------------------------------
FORMATS = ("csv", "json", "parquet")
TABLES_WITHOUT_DICTIONARY = ("data_dictionary", "manifest", "resumen_mensual_validacion")

# --- column types by name ----------------------------------------------------
DATES = [
    "fecha", "fecha_apertura", "fecha_alta", "fecha_registro", "fecha_venta", "fecha_devolucion", "fecha_compra",
    "fecha_ajuste", "fecha_solicitud", "fecha_prometida", "fecha_entrega", "fecha_inicio", "fecha_fin",
    "fecha_ingreso", "fecha_generacion",
]
FLAGS = [
    "es_fin_de_semana", "es_festivo_colombia", "es_ciudad_principal", "permite_domicilio", "atiende_b2b",
    "controla_inventario", "consentimiento_marketing", "cliente_activo", "requiere_logistica",
    "requiere_revision_calidad", "activa", "es_proveedor_principal",
]
MONEY = [
    "precio_lista", "costo_estandar", "valor_bruto", "descuento_total", "iva_total", "valor_total", "costo_total",
    "margen_bruto", "precio_unitario", "descuento_valor", "base_sin_iva", "iva_valor", "valor_total_linea",
    "costo_total_linea", "margen_bruto_linea", "valor_reintegrado", "gasto_marketing", "ventas_atribuidas_valor",
    "valor_impacto_costo", "costo_unitario", "subtotal_sin_iva", "valor_total_compra", "valor_inventario_costo",
    "monto_presupuestado", "monto_real", "monto_presupuesto", "monto_ejecutado", "variacion_presupuesto",
    "meta_ventas", "meta_margen_bruto", "salario_base_mensual", "costo_negociado", "costo_base_envio", "costo_envio",
]
RATES = [
    "iva_tasa", "descuento_pct", "roas", "costo_transaccion_pct", "margen_objetivo", "peso_demanda", "factor_demanda",
    "calificacion_servicio", "calificacion_promedio", "descuento_base_pct", "meta_tasa_devolucion",
]
WHOLE_NUMBERS = [
    "fecha_id", "anio", "mes_numero", "trimestre", "semana_iso", "dia_mes", "metros_cuadrados", "vida_util_dias",
    "lead_time_promedio_dias", "lead_time_dias", "cantidad_minima_pedido", "numero_lineas", "linea_numero",
    "cantidad", "cantidad_devuelta", "impresiones", "clics", "leads", "conversiones_atribuidas", "stock_inicial",
    "entradas_compras", "salidas_ventas", "ajuste_unidades", "merma_unidades", "stock_final", "punto_reorden",
    "stock_seguridad", "cobertura_dias", "cantidad_comprada", "dias_prometidos", "dias_reales_entrega",
    "dias_retraso", "filas_carga", "valores_nulos_o_blancos", "errores_fk_detectados", "duplicados_detectados",
    "ventas", "devoluciones", "meta_tickets", "meta_nps", "meta_entregas",
]
REALS = ["latitud", "longitud", "peso_estimado_kg", "ticket_promedio"]
ALWAYS_TEXT = ["sku", "moneda"]

TRUE_WORDS = ["true", "t", "1", "yes", "y", "si", "s", "sí"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]

# --- keys --------------------------------------------------------------------
PRIMARY_KEYS = {
    "dim_fecha": ("fecha_id",),
    "dim_ciudad": ("ciudad_id",),
    "dim_tienda": ("tienda_id",),
    "dim_area_negocio": ("area_id",),
    "dim_centro_costo": ("centro_costo_id",),
    "dim_categoria_producto": ("categoria_id",),
    "dim_producto": ("producto_id",),
    "dim_proveedor": ("proveedor_id",),
    "bridge_producto_proveedor": ("producto_id", "proveedor_id"),
    "dim_cliente": ("cliente_id",),
    "dim_empleado": ("empleado_id",),
    "dim_canal_venta": ("canal_id",),
    "dim_metodo_pago": ("metodo_pago_id",),
    "dim_campana_marketing": ("campana_id",),
    "dim_transportista": ("transportista_id",),
    "dim_motivo_devolucion": ("motivo_devolucion_id",),
    "fact_ventas_cabecera": ("venta_id",),
    "fact_ventas_detalle": ("detalle_venta_id",),
    "fact_devoluciones": ("devolucion_id",),
    "fact_marketing": ("marketing_id",),
    "fact_inventario_mensual": ("mes_carga", "tienda_id", "producto_id"),
    "fact_ajustes_inventario": ("ajuste_id",),
    "fact_compras": ("orden_compra_id",),
    "fact_logistica_entregas": ("entrega_id",),
    "fact_costos_mensual": ("costo_id",),
    "fact_presupuesto_mensual": ("presupuesto_id",),
    "fact_objetivos_mensuales": ("objetivo_id",),
    "fact_calidad_datos_carga": ("control_id",),
    "resumen_mensual_validacion": ("mes_carga",),
    "manifest": ("archivo",),
    "data_dictionary": ("tabla", "campo"),
    "schema_relationships": ("tabla_origen", "campo_origen", "tabla_destino", "campo_destino"),
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("dim_tienda", "ciudad_id", "dim_ciudad", "ciudad_id"),
    ("dim_cliente", "ciudad_id", "dim_ciudad", "ciudad_id"),
    ("dim_empleado", "tienda_id", "dim_tienda", "tienda_id"),
    ("dim_empleado", "area_id", "dim_area_negocio", "area_id"),
    ("dim_producto", "categoria_id", "dim_categoria_producto", "categoria_id"),
    ("dim_proveedor", "ciudad_id", "dim_ciudad", "ciudad_id"),
    ("bridge_producto_proveedor", "producto_id", "dim_producto", "producto_id"),
    ("bridge_producto_proveedor", "proveedor_id", "dim_proveedor", "proveedor_id"),
    ("fact_ventas_cabecera", "fecha_id", "dim_fecha", "fecha_id"),
    ("fact_ventas_cabecera", "tienda_id", "dim_tienda", "tienda_id"),
    ("fact_ventas_cabecera", "cliente_id", "dim_cliente", "cliente_id"),
    ("fact_ventas_cabecera", "canal_id", "dim_canal_venta", "canal_id"),
    ("fact_ventas_detalle", "venta_id", "fact_ventas_cabecera", "venta_id"),
    ("fact_ventas_detalle", "producto_id", "dim_producto", "producto_id"),
    ("fact_devoluciones", "detalle_venta_id", "fact_ventas_detalle", "detalle_venta_id"),
    ("fact_logistica_entregas", "venta_id", "fact_ventas_cabecera", "venta_id"),
    ("fact_compras", "producto_id", "dim_producto", "producto_id"),
    ("fact_compras", "proveedor_id", "dim_proveedor", "proveedor_id"),
    ("fact_inventario_mensual", "producto_id", "dim_producto", "producto_id"),
]

# --- domain codes ------------------------------------------------------------
# columns that get a "<column>_codigo" companion
CODED = [
    "estado_venta", "estado_linea", "tipo_pedido", "tipo_solucion", "estado_devolucion", "medio_principal",
    "motivo_ajuste", "estado_ajuste", "estado_orden", "motivo_compra", "estado_stock", "estado_entrega",
    "tipo_vehiculo", "tipo_registro", "fuente_registro", "tipo_presupuesto", "estado_sede", "tipo_sede", "especie",
    "unidad_medida", "nivel_rotacion", "estado_producto", "tipo_cliente", "genero", "segmento_cliente",
    "tipo_mascota_principal", "nivel_fidelidad", "rango_edad", "cargo", "tipo_contrato", "estado_empleado",
    "nivel_experiencia", "tipo_proveedor", "estado_proveedor", "tipo_campana", "moneda",
]
# the one companion whose name does not follow the rule
CODE_NAME_EXCEPTIONS = {"tipo_mascota_principal": "tipo_mascota_codigo"}
ALLOWED_VALUES = {
    "estado_venta": ("Emitida", "Facturada"),
    "estado_devolucion": ("Aprobada", "En revision", "Rechazada"),
    "estado_orden": ("Parcial", "Pendiente", "Recibida"),
    "estado_stock": ("Bajo", "Normal", "Sobrestock"),
    "estado_entrega": ("Cancelado en ruta", "Entregado", "Entregado tarde", "Intento fallido"),
}

# --- null policy texts -------------------------------------------------------
NOT_APPLICABLE = "NO_APLICA"
REASON_CARRIER = "transportista_tercero"
REASON_NO_COURIER = "sin_repartidor_informado"
REASON_CANCELLED = "cancelado_en_ruta"
REASON_NOT_DELIVERED = "pendiente_o_no_entregado"
REASON_NO_CAMPAIGN = "venta_sin_campana"

# --- tolerances --------------------------------------------------------------
ROW_TOLERANCE = 0.02
MONTH_TOLERANCE = 0.05

# arithmetic identities: table, description, expression that must be (near) zero, tolerance
IDENTITIES = [
    ("fact_ventas_cabecera", "valor_total = valor_bruto - descuento_total + iva_total",
     "valor_bruto - descuento_total + iva_total - valor_total", ROW_TOLERANCE),
    ("fact_ventas_cabecera", "margen_bruto = base_neta_sin_iva - costo_total",
     "valor_bruto - descuento_total - costo_total - margen_bruto", ROW_TOLERANCE),
    ("fact_ventas_detalle", "valor_total_linea = base_sin_iva + iva_valor",
     "base_sin_iva + iva_valor - valor_total_linea", ROW_TOLERANCE),
    ("fact_ventas_detalle", "margen_bruto_linea = base_sin_iva - costo_total_linea",
     "base_sin_iva - costo_total_linea - margen_bruto_linea", ROW_TOLERANCE),
    ("fact_compras", "valor_total_compra = subtotal_sin_iva + iva_valor",
     "subtotal_sin_iva + iva_valor - valor_total_compra", ROW_TOLERANCE),
    ("fact_inventario_mensual", "stock_final cuadra con movimientos",
     "stock_inicial + entradas_compras - salidas_ventas + ajuste_unidades - merma_unidades - stock_final", 0),
]
