"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark import fixed_values as fv
from tidemark.functions.columns import loose_hash, packed_hash, record_hash
from tidemark.operators.upsert import in_batch
from tidemark.workspace import stage

# a later month folder beats an earlier one and a month-less full load, as if loaded in that order
RECENCY = (fv.INGESTED_AT, fv.SOURCE_YEAR, fv.SOURCE_MONTH, fv.SOURCE_PATH, fv.SOURCE_FILE)


def latest_by_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = RECENCY) -> DataFrame:
    """Keep the newest row of every key.

    Newest means the greatest of the ``newest`` columns (those the frame has),
    NULLs last; rows that still tie are decided by all their remaining columns,
    so the winner never depends on the order rows arrive in.  Spark pushes the
    "first row only" below the shuffle (WindowGroupLimit): a key with a third of
    all rows sends one row per map task.
    """
    if not keys:
        return df
    lead = [c for c in newest if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    if not lead and not rest:
        return df.distinct()
    if fv.RECORD_HASH in rest and df.schema[fv.RECORD_HASH].dataType == T.StringType():
        # 64 characters that do not compress: the shuffle carries the 32 bytes they spell
        told = [packed_hash(fv.RECORD_HASH).alias("_hash"), loose_hash(fv.RECORD_HASH).alias("_otra")]
        narrow = df.select(*[f"`{c}`" for c in df.columns if c != fv.RECORD_HASH], *told)
        shown = F.coalesce(F.lower(F.hex("_hash")), F.col("_otra")).alias(fv.RECORD_HASH)
        return latest_by_key(narrow, keys, newest).select(*[shown if c == fv.RECORD_HASH else F.col(f"`{c}`") for c in df.columns])
    order = [F.col(f"`{c}`").desc_nulls_last() for c in lead + rest]
    place = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def with_hash_key(df: DataFrame, ignore: Sequence[str] = (fv.INGESTED_AT,)) -> DataFrame:
    """Add the record hash used as key by tables that have none."""
    columns = [c for c in df.columns if c not in ignore and c != fv.RECORD_HASH]
    return df.withColumn(fv.RECORD_HASH, record_hash(columns))


def latest_with_origin(df: DataFrame, keys: Sequence[str], origin: Sequence[str]) -> DataFrame:
    """``latest_by_key`` of rows with ``origin`` columns that are the same in all rows of a file.

    Origins, one a file, are numbered, the newest last.  Rows go through the dedup with the number alone, so a task
    sorts their cells and not, for every row, the texts of path, file, month and mode as well.
    """
    lead = [c for c in RECENCY if c in origin]
    order = [F.col(c).asc_nulls_first() for c in [*lead, *[c for c in origin if c not in lead]]]
    place = F.row_number().over(Window.orderBy(*order))  # over one row a file
    origins = stage(df.select(*origin).distinct().withColumn("_origen", place), "origins")
    known = origins.select(*[F.col(c).alias(f"_of_{c}") for c in origin], F.col("_origen"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in origin])
    cells = [f"`{c}`" for c in df.columns if c not in origin]
    newest = latest_by_key(df.join(known, same).select(*cells, "_origen"), keys, newest=["_origen"])
    return newest.join(origins, "_origen").select(*[f"`{c}`" for c in df.columns])


def keyed_batch(df: DataFrame, key: Sequence[str], origin: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """A batch with one row per key, and that key; the record hash where the table has no key.

    ``origin`` names the columns that are the same in all rows of a file.
    """
    if key and set(key) <= set(df.columns):
        return (latest_with_origin(df, key, origin) if origin else latest_by_key(df, key)), list(key)
    return newest_records(df), [fv.RECORD_HASH]


# types of which two values are equal exactly if their texts are, which the record hash is made of (zeros with a sign aside)
_TOLD_BY_TEXT = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType, T.FloatType, T.DoubleType)


def _minus_zero(c: str) -> Column:
    return F.coalesce((F.col(c) == 0) & F.col(c).cast("string").startswith("-"), F.lit(False))


def newest_records(df: DataFrame) -> DataFrame:
    """The newest row of every record hash, with the hash, which is computed afterwards.

    Equal rows are grouped by their columns: no hash (64 characters that do not compress) is shuffled, nothing is
    sorted, and copies are combined before the shuffle.  Grouping takes -0.0 for 0.0, which the hash tells apart, so
    the signs of zeros are a column of the grouping.  Rows with values of other types are told by their hashes.
    """
    fields = [f for f in df.schema.fields if f.name not in (fv.INGESTED_AT, fv.RECORD_HASH)]
    if not fields or not all(f.dataType == T.StringType() or isinstance(f.dataType, _TOLD_BY_TEXT) for f in fields):
        return latest_by_hash(with_hash_key(df))
    told = [f"`{f.name}`" for f in fields]
    reals = [c for c, f in zip(told, fields) if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    signs = F.lit(None).cast("string")
    if reals:
        signs = F.when(F.array_contains(F.array(*[_minus_zero(c) for c in reals]), True),
                       F.concat(*[F.when(_minus_zero(c), "-").otherwise("+") for c in reals]))
    keys = [*[F.col(c) for c in told], signs.alias("_signos")]
    one = df.groupBy(*keys).agg(F.max(fv.INGESTED_AT).alias(fv.INGESTED_AT)) if fv.INGESTED_AT in df.columns else df.select(*keys).distinct()

    def shown(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f"`{f.name}`" not in reals:
            return c
        negative = F.substring("_signos", reals.index(f"`{f.name}`") + 1, 1) == "-"
        return F.when(negative, F.lit(-0.0).cast(f.dataType)).otherwise(c).alias(f.name)

    return with_hash_key(one.select(*[shown(f) for f in df.schema.fields if f.name != fv.RECORD_HASH]))


def latest_by_hash(hashed: DataFrame) -> DataFrame:
    """The newest row of every record hash; rows with one hash differ in nothing but the time of ingestion."""
    if fv.INGESTED_AT not in hashed.columns:
        return hashed.dropDuplicates([fv.RECORD_HASH])
    place = F.row_number().over(Window.partitionBy(fv.RECORD_HASH).orderBy(F.col(fv.INGESTED_AT).desc_nulls_last()))
    return hashed.withColumn("_place", place).filter("_place = 1").drop("_place")


def distinct_records(df: DataFrame, *grain: str) -> DataFrame:
    """Number of distinct record hashes per ``grain``, as column ``registros_distintos``.

    Rows are counted by 64 bits of their hash, so that not all of it is shuffled.  Only rows that share these bits with
    another one of their group are told by the whole hash; they are none where hashes are unique, chance aside.
    """
    hashes = df.filter(F.col(fv.RECORD_HASH).isNotNull()).select(*grain, fv.RECORD_HASH, F.xxhash64(fv.RECORD_HASH).alias("_bits"))
    shared = stage(hashes.groupBy(*grain, "_bits").agg(F.count("*").alias("_filas")).filter("_filas > 1"), "shared-bits")
    told = in_batch(hashes, shared, [*grain, "_bits"]).groupBy(*grain).agg(F.count_distinct(fv.RECORD_HASH).alias("n"))
    parts = [hashes.groupBy(*grain).agg(F.count("*").alias("n")), shared.groupBy(*grain).agg((-F.sum("_filas")).alias("n")), told]
    return reduce(DataFrame.unionByName, parts).groupBy(*grain).agg(F.sum("n").alias("registros_distintos"))
