"""Run logs: what was loaded, what each silver step did, what still has to be archived."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import fixed_values as fv
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.upsert import in_batch, update_only
from tidemark.sources.tables import LakeTable

# fixed values: columns of the two logs and of the step summary
LOAD_LOG = """
load_id string, area string, table_name string, load_mode string, source_year string, source_month string,
source_path string, source_file_name string, source_format string, target_table string, target_path string,
record_count bigint, status string, error_message string, historic_path string, archived_at timestamp,
archive_status string, archive_error_message string, created_at timestamp, updated_at timestamp
"""
STEP_LOG = """
environment string, domain_name string, step_name string, table_name string, source_table string,
target_table string, input_rows bigint, output_rows bigint, status string, message string,
watermark_column string, previous_watermark timestamp, new_watermark timestamp, target_path string,
created_at timestamp, updated_at timestamp
"""
STEP_SUMMARY = """
step_name string, table_name string, status string, input_rows bigint, output_rows bigint,
previous_watermark timestamp, new_watermark timestamp, target_path string, message string
"""
ARCHIVE_COLUMNS = ("archived_at", "archive_status", "archive_error_message", "updated_at")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def entries(spark: SparkSession, schema: str, records: Sequence[Mapping]) -> DataFrame:
    """Log entries as a frame; what a record leaves out is NULL, its clock is set here."""
    now = datetime.now(timezone.utc)
    names = _names(schema)
    rows = []
    for r in records:
        unknown = set(r) - set(names)
        if unknown:
            raise ValueError(f"unknown log columns {sorted(unknown)}")
        full = {"created_at": now, "updated_at": now, **r}
        rows.append(tuple(full.get(n) for n in names))
    return spark.createDataFrame(rows, schema)


def append(spark: SparkSession, path: str, schema: str, records: Sequence[Mapping], origin: str = "") -> None:
    """Append entries; creates the log when it is the first time, does nothing without entries or for an origin logged before."""
    if records:
        LakeTable(spark, path).append(entries(spark, schema, records).coalesce(1), origin)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log; empty, with its columns, when it was never written."""
    log = LakeTable(spark, path)
    return log.read() if log.exists() else entries(spark, schema, [])


def record_archive_outcomes(spark: SparkSession, path: str, outcomes: DataFrame) -> int:
    """Store what became of archived files: an update of their load entries, none is added."""
    log = LakeTable(spark, path)
    if not log.exists():
        return 0
    done = F.col("archive_status") == fv.ARCHIVED
    updates = outcomes.select("load_id", "archive_status", "archive_error_message",
                              F.when(done, F.current_timestamp()).alias("archived_at"),
                              F.current_timestamp().alias("updated_at"))
    concerned = in_batch(log.read(), updates, ["load_id"])
    return log.upsert(apply_archive_updates(concerned, updates), ["load_id"])


# --- questions asked of the logs ---------------------------------------------

def latest_per(log: DataFrame, *keys: str) -> DataFrame:
    """Newest entry per key."""
    return latest_by_key(log, keys, newest=("updated_at", "created_at"))


def high_water_marks(log: DataFrame) -> DataFrame:
    """Highest mark reached by successful runs, per step and table."""
    done = log.filter(F.col("status") == fv.SUCCESS)
    return done.groupBy("step_name", "table_name").agg(F.max("new_watermark").alias("watermark"))


def high_water_mark(log: DataFrame, step: str, table: str):
    """One table's mark, or None before its first success."""
    found = high_water_marks(log.filter((F.col("step_name") == step) & (F.col("table_name") == table))).first()
    return found.watermark if found else None


def last_finished(log: DataFrame, step: str, table: str):
    """When a table's last run without a failure was logged, or None before the first."""
    done = (F.col("step_name") == step) & (F.col("table_name") == table) & (F.col("status") != fv.FAILED)
    return log.filter(done).agg(F.max("created_at").alias("at")).first().at


def step_summary(log: DataFrame) -> DataFrame:
    return log.select(*_names(STEP_SUMMARY))


def pending_archives(log: DataFrame) -> DataFrame:
    """Loaded files that have not been archived."""
    return log.filter((F.col("status") == fv.SUCCESS) & F.col("archived_at").isNull())


def in_archive_order(pending: DataFrame) -> DataFrame:
    return pending.orderBy("source_year", "source_month", "table_name")


def apply_archive_updates(log: DataFrame, updates: DataFrame) -> DataFrame:
    """Set the archive columns of the loads that have an update (the newest one per load)."""
    newest = latest_by_key(updates, ["load_id"], newest=("updated_at",))
    return update_only(log, newest, "load_id", ARCHIVE_COLUMNS)


def archive_outcomes(pending: DataFrame, landed: DataFrame, historic: DataFrame) -> DataFrame:
    """What becomes of each pending file, from the two listings (``path`` columns).

    Still landed: to be moved.  Already in the historic folder: counts as
    archived, so a repeated run changes nothing.  In neither: failed.
    """
    here = landed.select(F.col("path").alias("source_path"), F.lit(True).alias("_landed")).distinct()
    there = historic.select(F.col("path").alias("historic_path"), F.lit(True).alias("_historic")).distinct()
    seen = pending.join(here, "source_path", "left").join(there, "historic_path", "left")
    lost = F.col("_landed").isNull() & F.col("_historic").isNull()
    return seen.select(
        "load_id", "table_name", "source_path", "historic_path",
        F.when(lost, fv.FAILED).otherwise(fv.ARCHIVED).alias("archive_status"),
        F.coalesce(F.col("_landed"), F.lit(False)).alias("por_mover"),
        F.when(lost, "el archivo no esta en raw ni en historico").alias("archive_error_message"),
    )
