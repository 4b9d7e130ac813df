"""Reconciliation of published KPIs with silver facts and control totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as fv
from tidemark.functions.columns import month_of_row
from tidemark.operators.rollup import Lake, monthly, total

# measure, its column in the control table
MEASURES = {
    "numero_ventas": "ventas",
    "ventas_totales": "valor_total",
    "margen_bruto": "margen_bruto",
    "devoluciones": "devoluciones",
    "valor_reintegrado": "valor_reintegrado",
}
# published flag, measure, may differ by a tolerance
FLAGS = [
    ("ventas_match_silver", "ventas_totales", True),
    ("margen_match_silver", "margen_bruto", True),
    ("tickets_match_silver", "numero_ventas", False),
    ("devoluciones_match_silver", "devoluciones", False),
    ("valor_reintegrado_match_silver", "valor_reintegrado", True),
]


def _agree(a: str, b: str, tolerant: bool) -> Column:
    if not tolerant:
        return F.col(a) == F.col(b)
    return F.abs(F.col(a) - F.col(b)) <= F.lit(fv.MONTH_TOLERANCE).cast("decimal(4,2)")


def _all_true(flags: list[str]) -> Column:
    verdict = F.lit(True)
    for f in flags:
        verdict = verdict & F.coalesce(F.col(f), F.lit(False))
    return F.when(verdict, "PASS").otherwise("FAIL")


def gold_checks(kpis: DataFrame, lake: Lake, *, against_control: bool = False) -> DataFrame:
    """Per month: gold, silver and control figures, match flags and a verdict.

    A comparison with a missing figure is unknown and fails the month.  With
    ``against_control`` figures missing on both sides agree, and a second
    verdict compares gold with the control totals, which the first one only shows.
    """
    sold = monthly(lake["fact_ventas_cabecera"],
                   silver_numero_ventas=lake.rows_of("fact_ventas_cabecera"),
                   silver_ventas_totales=total("valor_total"), silver_margen_bruto=total("margen_bruto"))
    returned = monthly(lake["fact_devoluciones"],
                       silver_devoluciones=lake.rows_of("fact_devoluciones"),
                       silver_valor_reintegrado=total("valor_reintegrado"))
    control = lake["resumen_mensual_validacion"]
    control = control.select(month_of_row(control.columns).alias("_mes_control"),
                             *[F.col(c).alias(f"control_{m}") for m, c in MEASURES.items()])
    gold = kpis.select(fv.MONTH, *[F.col(m).alias(f"gold_{m}") for m in MEASURES])
    lined_up = (
        gold.join(sold, fv.MONTH, "left")
        .join(returned, fv.MONTH, "left")
        .join(control, gold[fv.MONTH] == F.col("_mes_control"), "left")
    )
    figures = [f"{side}_{m}" for m in MEASURES for side in ("gold", "silver", "control")]
    if not against_control:
        flags = {f: _agree(f"gold_{m}", f"silver_{m}", tolerant) for f, m, tolerant in FLAGS}
        compared = lined_up.select(fv.MONTH, *figures, *[c.alias(f) for f, c in flags.items()])
        return compared.withColumn("gold_quality_status", _all_true(list(flags)))

    def agree_or_both_missing(m: str, side: str, tolerant: bool) -> Column:
        a, b = f"gold_{m}", f"{side}_{m}"
        return F.coalesce(_agree(a, b, tolerant), F.col(a).isNull() & F.col(b).isNull())

    silver = {f: agree_or_both_missing(m, "silver", t) for f, m, t in FLAGS}
    controls = {f.replace("_silver", "_control"): agree_or_both_missing(m, "control", t) for f, m, t in FLAGS}
    compared = lined_up.select(fv.MONTH, *figures, *[c.alias(f) for f, c in (silver | controls).items()])
    return compared.withColumns({
        "gold_quality_status": _all_true(list(silver)),
        "control_status": _all_true(list(controls)),
    })
