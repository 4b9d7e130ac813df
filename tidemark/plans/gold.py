"""Gold: publish the monthly products, the KPIs built on them, and their reconciliation.

Products are stored by month.  ``refresh`` builds all months; ``refresh_changed`` finds the months of
the silver rows that came, changed or went since the products were published, builds those alone and
replaces their folders; the files of other months stay.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import fixed_values as fv
from tidemark.functions.columns import month_of_row
from tidemark.operators.rollup import Lake
from tidemark.plans import marts
from tidemark.plans.reconcile import gold_checks
from tidemark.plans.settings import Settings
from tidemark.sources.tables import LakeTable

# fixed values: the domain each product belongs to
PRODUCT_DOMAIN = {
    "mart_ventas_mensual": "comercial",
    "mart_ventas_producto_mensual": "comercial",
    "mart_devoluciones_mensual": "comercial",
    "mart_marketing_mensual": "comercial",
    "mart_inventario_mensual": "operaciones",
    "mart_compras_proveedores_mensual": "operaciones",
    "mart_logistica_mensual": "operaciones",
    "mart_finanzas_mensual": "finanzas",
    "mart_objetivos_mensual": "finanzas",
    "mart_kpis_ejecutivos_mensual": "shared",
    "gold_quality_checks": "gobierno",
}


KPIS, CHECKS = "mart_kpis_ejecutivos_mensual", "gold_quality_checks"
DIMENSIONS = ("dim_", "bridge_")
Months = Collection[str | None] | None  # None: all months
ROLLED_FROM = ("mart_ventas_mensual", "mart_ventas_producto_mensual")


def product_table(spark: SparkSession, settings: Settings, name: str) -> LakeTable:
    return LakeTable(spark, settings.in_domain(PRODUCT_DOMAIN[name]).table_path("gold", name), (fv.MONTH,))


def publish(spark: SparkSession, settings: Settings, name: str, df: DataFrame, months: Months = None, origin: str = "") -> int:
    """One write; the new version becomes current only if it has rows.  Given months, only theirs are replaced."""
    stamped = df.withColumns({fv.GOLD_LAYER: F.lit("gold"), fv.GOLD_AT: F.current_timestamp()})
    table = product_table(spark, settings, name)
    return table.publish(stamped, origin) if months is None else table.replace(stamped, months, origin)


def of_months(df: DataFrame, months: Months) -> DataFrame:
    """Rows of some months (all rows for None); a NULL month is a month of its own."""
    if months is None:
        return df
    month, named = month_of_row(df.columns), [m for m in months if m is not None]
    return df.filter(month.isin(named) | month.isNull() if None in months else month.isin(named))


def refresh(spark: SparkSession, settings: Settings, lake: Lake, *, months: Months = None, origin: str = "",
            only: Collection[str] = tuple(PRODUCT_DOMAIN)) -> DataFrame:
    """Publish every product, then KPIs and checks from the *published* products.

    Sales and product sales come first: what later products say about sales is rolled up
    from them, so each fact is scanned once.  The checks keep reading silver.  ``lake`` and ``months``
    go together: facts of those months alone.
    """
    summary, made = [], Lake(dict(lake), lake.keyed)

    def published(name: str) -> DataFrame:
        return of_months(product_table(spark, settings, name).read(), months)

    def put(name: str, df: DataFrame) -> None:
        summary.append((name, publish(spark, settings, name, df, months, origin)))

    for name, build in marts.PRODUCTS.items():
        if name in only:
            put(name, build(made))
        if name in ROLLED_FROM and name in only:
            made.rolled[name] = published(name)
    if KPIS in only:
        put(KPIS, marts.kpis({n: published(n) for n in marts.kpi_measures()}))
    if CHECKS in only:
        put(CHECKS, gold_checks(published(KPIS), lake))
    return spark.createDataFrame(summary, "table_name string, rows bigint")


def touched_months(changed: Mapping[str, list[DataFrame]]) -> Months:
    """Months of changed fact rows, before and after; None (all) where a table without months changed."""
    found = []
    for frames in changed.values():
        for df in frames:
            if fv.MONTH not in df.columns and fv.SOURCE_MONTH not in df.columns:
                return None
            found.append(df.select(month_of_row(df.columns).alias("mes")))
    if not found:
        return []
    return sorted((r.mes for r in reduce(DataFrame.unionByName, found).distinct().collect()), key=str)  # one row a month


def refresh_changed(spark: SparkSession, settings: Settings, domain_of: dict[str, str],
                    only: Collection[str] = tuple(PRODUCT_DOMAIN)) -> DataFrame:
    """Publish the months of silver rows that came, changed or went since the last publication.

    Every publication keeps the versions of the silver tables it was made from.  All months are built the
    first time, where products were made from different versions, and when a dimension changed.
    """
    tables = {t: LakeTable(spark, settings.in_domain(d).table_path("silver", t)) for t, d in domain_of.items()}
    now = {t: table.version() for t, table in tables.items()}
    states = [product_table(spark, settings, name).current() for name in only]
    made_from = {s.origen if s is not None else "" for s in states}
    before = json.loads(next(iter(made_from))) if len(made_from) == 1 and made_from != {""} else None
    months: Months = None
    if before is not None and before.keys() == now.keys():
        moved = [t for t in tables if before[t] != now[t]]
        if not any(t.startswith(DIMENSIONS) for t in moved):
            months = touched_months({t: tables[t].changed_since(before[t]) for t in moved})
    if months == []:
        return spark.createDataFrame([(name, 0) for name in only], "table_name string, rows bigint")
    silver = silver_lake(spark, settings, domain_of)

    def facts_of_months(table: str):
        return lambda: silver[table] if table.startswith(DIMENSIONS) else of_months(silver[table], months)

    lake = Lake({t: facts_of_months(t) for t in tables}, keyed=domain_of)
    return refresh(spark, settings, lake, months=months, origin=json.dumps(now, sort_keys=True), only=only)


def silver_lake(spark: SparkSession, settings: Settings, domain_of: dict[str, str]) -> Lake:
    """Published silver tables; their keys are unique because upserts wrote them."""
    def reader(table: str, domain: str):
        return lambda: LakeTable(spark, settings.in_domain(domain).table_path("silver", table)).read()
    return Lake({t: reader(t, d) for t, d in domain_of.items()}, keyed=domain_of)
