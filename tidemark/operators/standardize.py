"""Silver steps one to three: types and text, null policy, domain codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import fixed_values as fv
from tidemark.functions.columns import allowed_or_null, clean_text, domain_code, text_columns, typed


def blank_to_null(df: DataFrame) -> DataFrame:
    """Trim every text column; blanks become NULL (one projection for all columns)."""
    texts = text_columns(df)
    return df.select(*[clean_text(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def type_by_name(df: DataFrame) -> DataFrame:
    """Cast every column by the naming rules; bad cells become NULL, never an error."""
    return df.select(*[typed(f.name, f.dataType) for f in df.schema.fields])


def standardize(df: DataFrame) -> DataFrame:
    return type_by_name(blank_to_null(df))


# --- null policy -------------------------------------------------------------

def _holiday_names(have: set[str]) -> dict[str, Column]:
    if not {"es_festivo_colombia", "festivo_nombre"} <= have:
        return {}
    return {"festivo_nombre": F.when(F.col("es_festivo_colombia"), F.col("festivo_nombre"))}


def _corporate_staff(have: set[str]) -> dict[str, Column]:
    if "tienda_id" not in have:
        return {}
    store = F.col("tienda_id")
    return {
        "es_empleado_corporativo": store.isNull(),
        "tienda_id_modelo": F.coalesce(store, F.lit(fv.NOT_APPLICABLE)),
    }


def _missing_delivery_facts(have: set[str]) -> dict[str, Column]:
    out = {}
    if "empleado_repartidor_id" in have:
        by_carrier = F.when(F.col("transportista_id").isNotNull(), fv.REASON_CARRIER)
        out["empleado_repartidor_null_reason"] = F.when(
            F.col("empleado_repartidor_id").isNull(), by_carrier.otherwise(fv.REASON_NO_COURIER))
    if "fecha_entrega" in have:
        cancelled = F.when(F.col("estado_entrega") == "Cancelado en ruta", fv.REASON_CANCELLED)
        out["fecha_entrega_null_reason"] = F.when(
            F.col("fecha_entrega").isNull(), cancelled.otherwise(fv.REASON_NOT_DELIVERED))
    return out


def _sale_without_campaign(have: set[str]) -> dict[str, Column]:
    if "campana_id" not in have:
        return {}
    return {"campana_null_reason": F.when(F.col("campana_id").isNull(), fv.REASON_NO_CAMPAIGN)}


NULL_POLICY = {
    "dim_fecha": _holiday_names,
    "dim_empleado": _corporate_staff,
    "fact_logistica_entregas": _missing_delivery_facts,
    "fact_ventas_cabecera": _sale_without_campaign,
}


def explain_nulls(table: str, df: DataFrame) -> DataFrame:
    """Apply a table's null policy: blanked attributes, sentinel members, reason codes."""
    cleaned = blank_to_null(df)
    rule = NULL_POLICY.get(table)
    columns = rule(set(df.columns)) if rule else {}
    return cleaned.withColumns(columns) if columns else cleaned


# --- domain codes ------------------------------------------------------------

def code_name(column: str) -> str:
    return fv.CODE_NAME_EXCEPTIONS.get(column, f"{column}_codigo")


def add_domain_codes(df: DataFrame) -> DataFrame:
    """Add ``*_codigo`` for every known label column, and ``*_codigo_valido`` where values are listed."""
    out = {}
    for c in fv.CODED:
        if c not in df.columns:
            continue
        out[code_name(c)] = domain_code(c)
        if c in fv.ALLOWED_VALUES:
            out[f"{code_name(c)}_valido"] = allowed_or_null(c, fv.ALLOWED_VALUES[c])
    return df.withColumns(out) if out else df


# --- step state --------------------------------------------------------------

def stamp_step(df: DataFrame, step: str, domain: str | None = None) -> DataFrame:
    """Mark rows with the step they have reached."""
    marks = {fv.SILVER_STEP: F.lit(step), fv.SILVER_AT: F.current_timestamp()}
    if domain is not None:
        marks |= {fv.SILVER_DOMAIN: F.lit(domain), fv.SILVER_LAYER: F.lit("silver")}
    return df.withColumns(marks)


def awaiting(df: DataFrame, previous_step: str) -> DataFrame:
    """Rows that stopped right after ``previous_step``."""
    return df.filter(F.col(fv.SILVER_STEP) == previous_step) if fv.SILVER_STEP in df.columns else df
