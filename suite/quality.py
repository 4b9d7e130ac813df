"""Data-quality checks over the whole star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from suite.registry import query, table
from suite.sql import define, sql
from suite.tables import base_lake
from tidemark import fixed_values as fv
from tidemark.operators import quality
from tidemark.workspace import stage

RAW = "region nation customer supplier part orders lineitem".split()
# fixed values: keys and references of the raw test tables
RAW_KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
            "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]}
RAW_REFERENCES = [
    ("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("events", "user_id", "supplier", "s_suppkey"), ("documents", "doc_id", "labels", "doc_id"),
]


def _union(parts) -> DataFrame:
    return quality.with_status(reduce(DataFrame.unionByName, parts))


def _sql(parts: list[str]) -> str:
    return ("SELECT *, CASE WHEN failing_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
            + "\nUNION ALL ".join(parts) + ")")


def _row(t: str, name: str, count: str, description: str) -> str:
    return (f"SELECT '{t}' AS table_name, '{name}' AS check_name, 'ERROR' AS severity, "
            f"CAST(({count}) AS BIGINT) AS failing_count, '{description}' AS description")


def _unique_sql(t, keys):
    ks = ", ".join(keys)
    return _row(t, "primary_key_unique",
                f"SELECT count(*) FROM (SELECT {ks} FROM {t} GROUP BY {ks} HAVING count(*) > 1)", f"PK unica por {ks}")


def _not_null_sql(t, keys):
    return _row(t, "primary_key_not_null", f"SELECT count(*) FROM {t} WHERE " + " OR ".join(f"{k} IS NULL" for k in keys),
                f"PK no nula por {', '.join(keys)}")


def _not_empty_sql(t):
    return _row(t, "table_not_empty", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {t}",
                "La tabla Silver debe tener registros")


def _fk_sql(child, col, parent, pcol):
    return _row(child, f"fk_{col}_to_{parent}_{pcol}",
                f"SELECT count(DISTINCT {col}) FROM {child} c WHERE {col} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})", "Integridad referencial Silver")


@query("dq_pk_unique", _sql([_unique_sql(t, RAW_KEYS[t]) for t in RAW]))
def dq_pk_unique(spark, sf):
    return _union([quality.unique_key(t, table(spark, sf, t), RAW_KEYS[t]) for t in RAW])


@query("dq_pk_not_null", _sql([_not_null_sql(t, RAW_KEYS[t]) for t in RAW]))
def dq_pk_not_null(spark, sf):
    parts = [quality.row_checks(t, table(spark, sf, t), RAW_KEYS[t]) for t in RAW]
    return _union(parts).filter("check_name = 'primary_key_not_null'")


@query("dq_not_empty", _sql([_not_empty_sql(t) for t in RAW]))
def dq_not_empty(spark, sf):
    return _union([quality.row_checks(t, table(spark, sf, t)) for t in RAW])


@query("dq_fk", _sql([_fk_sql(*r) for r in RAW_REFERENCES]))
def dq_fk(spark, sf):
    tables = {name: table(spark, sf, name) for c, _, p, _ in RAW_REFERENCES for name in (c, p)}
    return quality.with_status(quality.reference_checks(RAW_REFERENCES, tables, tables))


# the star's identities, and one that the independent order totals must break
EXTRA = ("control_pedidos", "o_total cuadra con las lineas", "o_total - valor_total", fv.ROW_TOLERANCE)
IDENTITY_SOURCES = {"fact_ventas_cabecera": "header", "fact_ventas_detalle": "placed", "fact_compras": "bought",
                    "fact_inventario_mensual": "stock", "control_pedidos": "order_control"}
define("order_control", ("header", "sold"), "SELECT venta_id, o_total, valor_total FROM header JOIN sold USING (venta_id)")


def _identity_sql(t, description, residual, tolerance):
    return _row(t, "arithmetic_consistency",
                f"SELECT count(*) FROM {IDENTITY_SOURCES[t]} WHERE abs(CAST({residual} AS DOUBLE)) > {tolerance}", description)


IDENTITIES = [*fv.IDENTITIES, EXTRA]


@query("dq_arithmetic", sql(_sql([_identity_sql(*i) for i in IDENTITIES]), *IDENTITY_SOURCES.values()))
def dq_arithmetic(spark, sf):
    lake = base_lake(spark, sf, staged="lines")
    totals = table(spark, sf, "orders").selectExpr("cast(o_orderkey as string) as venta_id",
                                                   "cast(o_totalprice as decimal(18,2)) as o_total")
    frames = {**{t: lake[t] for t in IDENTITY_SOURCES if t != "control_pedidos"},
              "control_pedidos": lake["fact_ventas_cabecera"].join(totals, "venta_id")}
    parts = [quality.row_checks(t, df, (), [(d, e, tol) for name, d, e, tol in IDENTITIES if name == t])
             for t, df in frames.items()]
    return _union(parts).filter("check_name = 'arithmetic_consistency'")


REPORTED = ("dim_ciudad dim_tienda dim_producto dim_proveedor bridge_producto_proveedor dim_cliente dim_canal_venta "
            "fact_ventas_cabecera fact_ventas_detalle fact_devoluciones fact_compras fact_logistica_entregas "
            "fact_inventario_mensual resumen_mensual_validacion").split()
REPORT_SQL = {
    "dim_ciudad": "SELECT ciudad_id FROM city", "dim_tienda": "SELECT c_mktsegment AS tienda_id, CAST(min(c_nationkey) AS VARCHAR) AS ciudad_id FROM customer GROUP BY 1",
    "dim_producto": "SELECT producto_id, producto_especie AS categoria_id FROM product",
    "dim_proveedor": "SELECT CAST(s_suppkey AS VARCHAR) AS proveedor_id, CAST(s_nationkey AS VARCHAR) AS ciudad_id FROM supplier",
    "bridge_producto_proveedor": "SELECT * FROM terms",
    "dim_cliente": "SELECT CAST(c_custkey AS VARCHAR) AS cliente_id, CAST(c_nationkey AS VARCHAR) AS ciudad_id FROM customer",
    "dim_canal_venta": "SELECT canal_id FROM channel", "fact_ventas_cabecera": "SELECT * FROM header",
    "fact_ventas_detalle": "SELECT * FROM placed", "fact_devoluciones": "SELECT * FROM back",
    "fact_compras": "SELECT * FROM bought", "fact_logistica_entregas": "SELECT * FROM shipped",
    "fact_inventario_mensual": "SELECT * FROM stock", "resumen_mensual_validacion": "SELECT * FROM control",
}
for _name, _body in REPORT_SQL.items():
    define(_name, ("city", "product", "terms", "channel", "header", "placed", "back", "bought", "shipped", "stock", "control"), _body)


def _report_sql() -> str:
    parts, skipped = [], []
    for t in REPORTED:
        keys = fv.PRIMARY_KEYS[t]
        parts += [_unique_sql(t, keys), _not_null_sql(t, keys), _not_empty_sql(t)]
        parts += [_row(t, "arithmetic_consistency", f"SELECT count(*) FROM {t} WHERE abs(CAST({e} AS DOUBLE)) > {tol}", d)
                  for name, d, e, tol in fv.IDENTITIES if name == t]
    for c, col, p, pcol in fv.FOREIGN_KEYS:
        if c in REPORTED and p in REPORTED:
            parts.append(_fk_sql(c, col, p, pcol))
        elif c in REPORTED:
            skipped.append(f"SELECT '{c}', 'fk_{col}_to_{p}_{pcol}', 'INFO', NULL, 'Tabla o columna ausente', 'SKIPPED'")
    return sql(_sql(parts) + "".join(f"\nUNION ALL {s}" for s in skipped), *REPORTED)


# what the checks read of stock: its key and the terms of its identity
STOCK_CHECKED = [*fv.PRIMARY_KEYS["fact_inventario_mensual"], "stock_inicial", "entradas_compras", "salidas_ventas", "ajuste_unidades",
                 "merma_unidades", "stock_final"]


@query("dq_report", _report_sql())
def dq_report(spark, sf):
    lake = base_lake(spark, sf, staged="lines sales orders")
    tables = {t: lake[t] for t in REPORTED}
    stock = tables["fact_inventario_mensual"].select(*STOCK_CHECKED)
    tables |= {"fact_inventario_mensual": stage(stock, "fact_inventario_mensual"),  # read by several checks each
               "bridge_producto_proveedor": stage(tables["bridge_producto_proveedor"].select(*fv.PRIMARY_KEYS["bridge_producto_proveedor"]), "terms")}
    return quality.worst_first(quality.report(tables, spark))
