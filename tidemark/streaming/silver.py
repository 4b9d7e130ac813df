"""The silver refresh of a table as an available-now stream.

The stream takes the folders that batches brought to the bronze table; its checkpoint is the mark.  Each
micro-batch passes the four steps and is merged in one write, during which the rows of every step are observed;
data and log entries carry the batch as their origin, so a batch that is replayed after a failure changes neither twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed_values as fv
from tidemark.contracts import TableContract, merge_keys
from tidemark.plans import silver
from tidemark.plans.bronze import PARTITIONS
from tidemark.plans.settings import Settings
from tidemark.sources import audit
from tidemark.sources.tables import LakeTable

VERSION_FOLDER = "/(version=[^/]+)/"


def refresh_new_rows(spark: SparkSession, settings: Settings, table: str, checkpoint: str,
                     contract: TableContract | None = None) -> StreamingQuery:
    """Carry what is new in a table's bronze folders to silver; the returned query ends by itself.

    The table must have been loaded once, as its columns are those of its current version.
    """
    bronze = LakeTable(spark, settings.table_path("bronze", table), PARTITIONS)
    schema = bronze.read().schema
    arriving = (spark.readStream.schema(schema).option("basePath", bronze.path).parquet(bronze.new_folders)
                .select(*[F.col(f"`{c}`") for c in schema.names], F.col("_metadata.file_path").alias("_archivo")))

    def merge(batch: DataFrame, batch_id: int) -> None:
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        carry(spark, settings, table, contract, bronze, batch, f"{query_id}#{batch_id}")

    return (
        arriving.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def carry(spark: SparkSession, settings: Settings, table: str, contract: TableContract | None, bronze: LakeTable,
          batch: DataFrame, origin: str) -> None:
    """One micro-batch through all steps, and its log entries; rows of folders that no commit names are left out."""
    folder = F.regexp_extract("_archivo", VERSION_FOLDER, 1)
    found = [r.f for r in batch.select(folder.alias("f")).distinct().collect()]  # one row a bronze batch
    rows = batch.filter(folder.isin(bronze.committed(found))).drop("_archivo")
    target = LakeTable(spark, settings.table_path("silver", table), PARTITIONS)
    log = audit.read(spark, settings.log_path("silver"), audit.STEP_LOG)
    record = silver.first_record(settings, table, audit.high_water_mark(log, fv.STEPS[0], table))
    seen = silver.StepRows()
    fresh = seen.arriving(rows, F.max(fv.INGESTED_AT).alias("mark"))
    done = silver.run_steps(table, fresh, domain=settings.domain, sales=silver.sales_of(spark, settings, table), contract=contract, seen=seen)
    if target.has_batch(origin):
        done.write.format("noop").mode("overwrite").save()  # merged before the failure, but perhaps not logged: only its figures are made again
    else:
        target.upsert(done, merge_keys(table, done.columns, contract), origin)
    audit.append(spark, settings.log_path("silver"), audit.STEP_LOG, silver.step_records(record, seen, seen.first().get("mark")), origin)
