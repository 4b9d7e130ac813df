"""Scans of landed files and their conformance to a table contract."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import fixed_values as fv
from tidemark.contracts import DICTIONARY, TableContract
from tidemark.functions.columns import loses_fraction, whole_number
from tidemark.sources.paths import literal, plain

REJECTED_LINE, REJECT_REASON = "_linea_rechazada", "_motivo_rechazo"


def _literal(paths: str | Sequence[str]) -> list[str]:
    return [literal(p) for p in ([paths] if isinstance(paths, str) else paths)]


def _with_line(schema: T.StructType, rejected: str | None) -> T.StructType:
    return T.StructType([*schema.fields, *([T.StructField(rejected, T.StringType())] if rejected else [])])


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
             header: bool = True, rejected: str | None = None) -> DataFrame:
    """CSV with an explicit schema; without one every column is text named by the header.

    Types are never inferred: '007' stays '007'.  Header names are checked
    against the schema in every file read.  A line with more or fewer cells than the
    schema stands as a whole in the column ``rejected``, if one is named.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        schema = _with_line(schema, rejected)
        if rejected:
            # with pruned columns a line's other cells would not be looked at
            reader = reader.option("columnNameOfCorruptRecord", rejected).option("columnPruning", False)
        reader = reader.schema(schema)
        if header:
            reader = reader.option("enforceSchema", False)
    return reader.csv(paths)


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
              rejected: str | None = None) -> DataFrame:
    """Line-delimited JSON; without a schema Spark reads the files once more to infer one.

    With a schema, a line that is no JSON object stands as a whole in the column ``rejected``, if one is named.
    """
    if schema is None:
        return spark.read.json(paths)
    reader = spark.read.option("columnNameOfCorruptRecord", rejected) if rejected else spark.read
    return reader.schema(_with_line(schema, rejected)).json(paths)


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def file_columns(spark: SparkSession, fmt: str, paths: Sequence[str]) -> list[str]:
    """Column names the files of a batch bring together (CSV: those of the first file)."""
    paths = _literal(paths)
    if fmt == "csv":
        return spark.read.option("header", True).csv(paths).columns
    if fmt == "parquet":
        return spark.read.parquet(*paths).columns
    keys = spark.read.text(paths).select(F.explode(F.json_object_keys("value")).alias("k")).distinct()
    return sorted(r.k for r in keys.toLocalIterator())


def json_keys(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, keys) of JSON files, from one pass over their lines."""
    lines = spark.read.text(_literal(paths)).select(plain(F.col("_metadata.file_path")).alias("path"), F.explode(F.json_object_keys("value")).alias("k"))
    return lines.groupBy("path").agg(F.collect_set("k").alias("keys"))


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, line): the first line of every CSV file, from one pass however many files there are.

    Lines of all files are read, but only one a file leaves its task.  Files without any line have no row.
    """
    lines = spark.read.text(_literal(paths)).select(
        plain(F.col("_metadata.file_path")).alias("path"), F.col("value"), F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().alias("place"))
    first = lines.filter((F.col("begin") == 0) & (F.trim("value") != ""))
    return first.groupBy("path").agg(F.min_by("value", "place").alias("line"))


def header_cells(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line]), ()))


def read_batch(spark: SparkSession, fmt: str, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """All files of a batch in one scan, text for CSV and JSON, plus where each row came from.

    ``REJECTED_LINE`` and ``REJECT_REASON`` are NULL but for lines that do not fit; what else such a row holds is no data.
    """
    if fmt not in fv.FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {', '.join(fv.FORMATS)}")
    columns = list(columns or file_columns(spark, fmt, paths))
    if fmt == "parquet":
        df, reason = read_parquet(spark, _literal(paths)).withColumn(REJECTED_LINE, F.lit(None).cast("string")), F.lit(None).cast("string")
    elif fmt == "json":
        df, reason = read_json(spark, _literal(paths), text_schema(columns), REJECTED_LINE), F.lit("no JSON object")
    else:
        df = read_csv(spark, _literal(paths), text_schema(columns), rejected=REJECTED_LINE)
        unquoted = F.regexp_replace(REJECTED_LINE, r'"([^"]|"")*"', "")
        cells = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
        reason = F.when(cells == len(columns), "cells cannot be told apart").otherwise(
            F.concat(F.lit(f"{len(columns)} cells expected, found "), cells))
    rejected = F.col(REJECTED_LINE).isNotNull()
    return df.select("*", F.when(rejected, reason).alias(REJECT_REASON), plain(F.col("_metadata.file_path")).alias(fv.SOURCE_PATH),
                     plain(F.col("_metadata.file_name")).alias(fv.SOURCE_FILE))


def contract_cast(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    return whole_number(c) if kind == "bigint" else c.try_cast(kind)


def conform(df: DataFrame, contract: TableContract | None, keep: Sequence[str] = ()) -> DataFrame:
    """Project to the contract, in its order, cast to its types; bad cells become NULL."""
    if contract is None:
        return df
    shaped = [contract_cast(n, t).alias(n) for n, t in contract.columns]
    return df.select(*shaped, *[F.col(c) for c in keep if c in df.columns])


def lost_cells(raw: DataFrame, contract: TableContract) -> list[Column]:
    """Per contract column: cells with text that the cast to the contract type turned into NULL or cut a fraction off."""
    def lost(n: str, t: str) -> Column:
        gone = (F.trim(F.col(f"`{n}`").cast("string")) != "") & contract_cast(n, t).isNull()
        return gone | loses_fraction(f"`{n}`") if t == "bigint" else gone
    fits = F.col(REJECTED_LINE).isNull() if REJECTED_LINE in raw.columns else F.lit(True)
    return [F.count_if(fits & lost(n, t)).alias(n) for n, t in contract.columns if t != "string"]


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The data dictionary, with each column's place in the file."""
    # one small file: ids given in reading order keep the order of its lines
    rows = read_csv(spark, path, DICTIONARY.text_struct())
    return rows.withColumn("posicion", F.monotonically_increasing_id())
