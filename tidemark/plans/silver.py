"""Silver: typed, explained, coded and derived tables from bronze.

The four steps are column logic, so a batch normally passes them as one plan and
is written once.  How many rows arrived and left each step, and the new mark, are
observed while that write runs.  The step a row has reached is stored with it; ``resume``
finishes rows that an earlier, partial run left behind.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark import fixed_values as fv
from tidemark.contracts import TableContract, merge_keys
from tidemark.operators.dedup import keyed_batch, latest_by_hash, latest_by_key
from tidemark.operators.measures import DAYS, days_to_return, derive
from tidemark.operators.upsert import in_batch
from tidemark.operators.quality import report, stamped
from tidemark.operators.standardize import add_domain_codes, awaiting, explain_nulls, stamp_step, standardize
from tidemark.plans.bronze import PARTITIONS
from tidemark.plans.settings import Settings
from tidemark.sources import audit
from tidemark.sources.tables import LakeTable


RETURNS, SALES = "fact_devoluciones", "fact_ventas_cabecera"
ARRIVED = "arrived"  # what comes in before the first step of a run


class StepRows:
    """Rows that enter and leave each step, observed in the plans that a run writes.

    Figures are there once the plans were written.  They are counts of tasks: where an executor is
    lost, a task that had been counted and runs again is counted again.
    """

    def __init__(self):
        self._plans: list[list[tuple[str, Observation]]] = []

    def arriving(self, df: DataFrame, *more: Column) -> DataFrame:
        """Start of a plan; ``more`` are further aggregates of the rows that come in."""
        self._plans.append([])
        return self.leaving(ARRIVED, df, *more)

    def leaving(self, step: str, df: DataFrame, *more: Column) -> DataFrame:
        seen = Observation()
        self._plans[-1].append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *more)

    def first(self) -> dict:
        """What was observed of the newest plan's arriving rows."""
        return _figures(self._plans[-1][0][1])

    def totals(self) -> tuple[Counter, Counter]:
        """Rows in and out by step, over all plans."""
        came, went = Counter(), Counter()
        for plan in self._plans:
            rows = [(step, _figures(seen).get("rows") or 0) for step, seen in plan]
            for (_, before), (step, after) in zip(rows, rows[1:]):
                came[step] += before
                went[step] += after
        return came, went


def _figures(seen: Observation) -> dict:
    """What was observed; nothing of a plan that Spark found to be empty before it ran."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return {}


def newer_than(df: DataFrame, mark, column: str = fv.INGESTED_AT) -> DataFrame:
    """Rows above a high-water mark; all rows when there is no mark yet or no such column."""
    return df.filter(F.col(column) > F.lit(mark)) if mark is not None and column in df.columns else df


def one_row_per_key(table: str, df: DataFrame, contract: TableContract | None) -> DataFrame:
    """The newest row per key; rows of a table without a key are told by their record hash."""
    key = merge_keys(table, df.columns, contract)
    if key != [fv.RECORD_HASH]:
        return latest_by_key(df, key)
    return latest_by_hash(df) if fv.RECORD_HASH in df.columns else keyed_batch(df, ())[0]


def run_step(step: str, table: str, df: DataFrame, *, domain: str, sales: DataFrame | None = None,
             contract: TableContract | None = None) -> DataFrame:
    """One step over a frame, stamped."""
    if step == "schema_standardization":
        return stamp_step(one_row_per_key(table, standardize(df), contract), step, domain)
    if step == "null_corrections":
        out = explain_nulls(table, df)
    elif step == "domain_normalization":
        out = add_domain_codes(df)
    elif step == "business_derivations":
        out = derive(table, df, sales)
    else:
        raise ValueError(f"unknown step {step!r}; expected one of {', '.join(fv.STEPS)}")
    return stamp_step(out, step)


def run_steps(table: str, df: DataFrame, *, domain: str, after: str | None = None, sales: DataFrame | None = None,
              contract: TableContract | None = None, seen: StepRows | None = None) -> DataFrame:
    """All steps that follow ``after`` (all four without it), as one lazy plan; ``seen`` observes the rows that leave each."""
    start = fv.STEPS.index(after) + 1 if after else 0
    for step in fv.STEPS[start:]:
        df = run_step(step, table, df, domain=domain, sales=sales, contract=contract)
        df = seen.leaving(step, df) if seen else df
    return df


def _silver(spark: SparkSession, settings: Settings, table: str) -> LakeTable:
    return LakeTable(spark, settings.table_path("silver", table), PARTITIONS)


def sales_of(spark: SparkSession, settings: Settings, table: str) -> DataFrame | None:
    if table != RETURNS:
        return None
    sales = _silver(spark, settings, SALES)
    return sales.read() if sales.exists() else None


def rederive_returns(spark: SparkSession, settings: Settings, since, contract: TableContract | None = None,
                     seen: StepRows | None = None) -> int:
    """Look sales up again for stored returns whose sale arrived or changed after a moment; returns how many changed.

    Sales that arrive after their returns find them by a reverse semi join, from the folders of the sales table
    that merges since then have written; only returns whose figure differs are merged.
    """
    target, sales = _silver(spark, settings, RETURNS), _silver(spark, settings, SALES)
    if since is None or not target.exists() or not sales.exists():
        return 0
    stored = target.read()
    before = F.col(DAYS) if DAYS in stored.columns else F.lit(None).cast("int")
    moved = sales.read_since(since).select("venta_id").distinct()
    looked_up = days_to_return(in_batch(stored, moved, ["venta_id"]).withColumn("_antes", before), sales.read())
    differ = looked_up.filter(~F.col(DAYS).eqNullSafe(F.col("_antes"))).drop("_antes")
    if seen:
        differ = seen.arriving(differ)
    again = stamp_step(differ, fv.STEPS[-1])
    if seen:
        again = seen.leaving(fv.STEPS[-1], again)
    return target.upsert(again, merge_keys(RETURNS, again.columns, contract))


def first_record(settings: Settings, table: str, mark) -> dict:
    return dict(
        environment=settings.environment, domain_name=settings.domain, step_name=fv.STEPS[0], table_name=table,
        source_table=f"bronze.{settings.domain}.{table}", target_table=f"silver.{settings.domain}.{table}",
        watermark_column=fv.INGESTED_AT, previous_watermark=mark, target_path=settings.table_path("silver", table))


def refresh_table(spark: SparkSession, settings: Settings, table: str, contract: TableContract | None = None) -> list[dict]:
    """Carry a table's new bronze rows to silver and finish rows that wait between steps.

    Returns the run's log records, one per step; a failure is a record too.
    """
    step, log_path = fv.STEPS[0], settings.log_path("silver")
    log = audit.read(spark, log_path, audit.STEP_LOG)
    mark = audit.high_water_mark(log, step, table)
    target = _silver(spark, settings, table)
    record = first_record(settings, table, mark)
    try:
        source = LakeTable(spark, settings.table_path("bronze", table), PARTITIONS)
        if not source.exists():
            return [record | dict(status=fv.NO_DATA, input_rows=0, output_rows=0, message="no bronze table")]
        seen = StepRows()
        resume_table(spark, settings, table, contract, seen)
        if table == RETURNS:
            rederive_returns(spark, settings, audit.last_finished(log, step, table), contract, seen)
        fresh = seen.arriving(newer_than(source.read_since(mark), mark), F.max(fv.INGESTED_AT).alias("mark"))
        done = run_steps(table, fresh, domain=settings.domain, sales=sales_of(spark, settings, table), contract=contract, seen=seen)
        merged = target.upsert(done, merge_keys(table, done.columns, contract))
        return step_records(record, seen, seen.first().get("mark") if merged else None)
    except Exception as e:  # noqa: BLE001  a bad table is an outcome, not the end of the run
        return [record | dict(status=fv.FAILED, input_rows=0, output_rows=0, new_watermark=mark, message=str(e))]


def step_records(record: dict, seen: StepRows, top) -> list[dict]:
    """Log records of all steps, with the rows each of them took and gave; ``top`` is the new mark, None if nothing arrived."""
    came, went = seen.totals()
    if top is None:
        record |= dict(status=fv.NO_DATA, new_watermark=record["previous_watermark"], message="no rows above the mark")
    else:
        record |= dict(status=fv.SUCCESS, new_watermark=top)
    first, path = fv.STEPS[0], record["target_table"]
    return [record | dict(input_rows=came[first], output_rows=went[first])] + [record | dict(step_name=step, source_table=path, status=fv.SUCCESS if came[step] else fv.NO_DATA, input_rows=came[step],
                          output_rows=went[step], watermark_column=None, previous_watermark=None,
                          message=None if came[step] else record.get("message")) for step in fv.STEPS[1:]]


def resume_table(spark: SparkSession, settings: Settings, table: str, contract: TableContract | None = None,
                 seen: StepRows | None = None) -> int:
    """Finish rows that stopped between steps; returns how many were merged."""
    target, merged = _silver(spark, settings, table), 0
    if not target.exists() or target.read().filter(F.col(fv.SILVER_STEP) != fv.STEPS[-1]).isEmpty():
        return 0
    for step in fv.STEPS[:-1]:
        waiting = awaiting(target.read(), step)
        if not waiting.isEmpty():
            waiting = seen.arriving(waiting) if seen else waiting
            done = run_steps(table, waiting, domain=settings.domain, after=step, sales=sales_of(spark, settings, table), seen=seen)
            merged += target.upsert(done, merge_keys(table, done.columns, contract))
    return merged


def refresh(spark: SparkSession, settings: Settings, tables: Iterable[str] | Mapping[str, TableContract]) -> DataFrame:
    """Refresh a domain's tables, sales before the returns that look them up; returns the step summary.

    Given contracts, their keys count.  Every table's records are stored as soon as it is done.
    """
    contracts = tables if isinstance(tables, Mapping) else {}
    log_path, all_records = settings.log_path("silver"), []
    for t in sorted(tables, key=lambda t: (t == RETURNS, t)):
        records = refresh_table(spark, settings, t, contracts.get(t))
        audit.append(spark, log_path, audit.STEP_LOG, records)
        all_records += records
    if not all_records:
        all_records = [dict(
            environment=settings.environment, domain_name=settings.domain, step_name=fv.STEPS[0],
            table_name=fv.NO_TABLES, input_rows=0, output_rows=0, status=fv.NO_DATA, message="no tables")]
        audit.append(spark, log_path, audit.STEP_LOG, all_records)
    return audit.step_summary(audit.entries(spark, audit.STEP_LOG, all_records))


def check(spark: SparkSession, settings: Settings, tables: dict[str, DataFrame],
          shared: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run and publish the quality report of a domain's silver tables; their parents may lie in ``shared``."""
    published = LakeTable(spark, settings.table_path("silver", "silver_quality_checks"))
    published.publish(stamped(report(tables, spark, shared=shared), settings.environment, settings.domain))
    return published.read()
