"""The landing zone: which files are there, and what each one is.

Files lie directly in a year folder (a *full* load) or in its month folders
``01`` .. ``12`` (an *incremental* load); anything deeper or elsewhere is not
part of the zone.  Classification is column logic over a frame of paths, so a
listing of any length stays distributed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import fixed_values as fv
from tidemark.sources.paths import literal

MONTH_FOLDER = "^(0[1-9]|1[0-2])$"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below a folder, names and sizes only (contents are never read); empty if there is none.

    Spark lists no files without a byte.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(literal(folder))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return found.select("path", "length", "modificationTime")


def classify(files: DataFrame, year_folder) -> DataFrame:
    """Turn ``path`` into file name, format, table, month and load mode.

    ``year_folder`` (text or column) is the folder the year's files lie in, given the
    way it occurs inside the paths.  A file whose format is not supported is kept
    with ``motivo_rechazo`` set: one stray file does not stop the others.
    """
    folder = F.lit(year_folder) if isinstance(year_folder, str) else year_folder
    below = F.call_function("substring_index", F.col("path"), F.concat(folder, F.lit("/")), F.lit(-1))
    inside = F.split(below, "/")
    depth = F.size("_parts")
    name = F.element_at("_parts", -1)
    month = F.when((depth == 2) & F.element_at("_parts", 1).rlike(MONTH_FOLDER), F.element_at("_parts", 1))
    placed = (
        files.withColumn("_parts", inside)
        .withColumns({"archivo": name, "mes": month, "_depth": depth})
        .filter((F.col("_depth") == 1) | F.col("mes").isNotNull())
    )
    suffix = F.lower(F.regexp_extract("archivo", r"\.([^.]+)$", 1))
    return placed.select(
        *files.columns,
        "archivo",
        "mes",
        F.when(F.col("mes").isNull(), "full").otherwise("incremental").alias("modo"),
        F.nullif(suffix, F.lit("")).alias("formato"),
        table_name(F.col("archivo"), F.col("mes")).alias("tabla"),
        F.when(suffix == "", "sin_extension")
        .when(~suffix.isin(*fv.FORMATS), "formato_no_soportado").alias("motivo_rechazo"),
    )


def table_name(file_name, month):
    """Table of a file: its name without the extension and without the month of its folder."""
    stem = F.regexp_replace(file_name, r"(?i)\.(csv|json|parquet)$", "")
    mark = F.concat(F.lit("_"), F.coalesce(month, F.lit("")))
    dated = month.isNotNull() & stem.endswith(mark)
    return F.when(dated, F.regexp_replace(stem, "_[0-9]{2}$", "")).otherwise(stem)


def in_load_order(files: DataFrame) -> DataFrame:
    return files.orderBy(F.coalesce("mes", F.lit("00")), "archivo")
