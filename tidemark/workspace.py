"""Where a run may write: a folder every executor can reach.

The cluster names a shared folder in ``spark.checkpoint.dir``; runs take a new
subfolder of it.  Where that is unset, the session's warehouse holds them; if that
lies on a local disk, only a local master can use it, and any other is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    warehouse, master = spark.conf.get("spark.sql.warehouse.dir").rstrip("/"), spark.sparkContext.master
    if not needs_no_sharing(master) and (warehouse.startswith("file:") or "://" not in warehouse):
        raise RuntimeError(f"{CHECKPOINT_DIR} names no shared folder, and {warehouse} is a local one for the executors of {master}")
    return f"{warehouse}/_staged"


def needs_no_sharing(master: str) -> bool:
    """Do driver and executors of a master share their disk, being one process?"""
    return master == "local" or master.startswith("local[")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str, file_rows: int = 0) -> DataFrame:
    """Write a frame once and read it back: later readers prune columns, and its lineage ends here.

    ``file_rows`` bounds the rows of a file, and by that, as Spark counts every opened file as some megabytes, those of a
    reading task, however few bytes a row takes.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.option("maxRecordsPerFile", file_rows).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
