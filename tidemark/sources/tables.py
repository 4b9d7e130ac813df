"""Versioned parquet tables.

A parquet folder cannot be overwritten while it is being read, and a reader must
never see half a refresh.  So every change writes new folders and then appends one
row to the table's commit log; the newest row lists the folders the table
consists of.  A job that dies before that row leaves the old version current.
Writers of one table take turns, as in the monthly schedule: folders have names of
their own, and a commit whose base is no longer the newest version is refused, so a
second writer gets an error and never takes a write away.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager
from datetime import datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tidemark import fixed_values as fv
from tidemark.functions.columns import loose_hash, packed_hash
from tidemark.operators.upsert import in_batch
from tidemark.sources.paths import literal

LOG_SCHEMA = "version bigint, filas bigint, carpetas array<struct<ruta:string,filas:bigint>>, esquema string, origen string, estado string, " \
             "momento bigint"
FOLDER = r"^.*/(version=[^/]+(?:/[^/]+=[^/]*)*)/[^/]+$"


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how a folder name shows that its partition value is NULL
STAMP_TYPE = "spark.sql.parquet.outputTimestampType"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FOLDERS = 16  # partition folders a task writes side by side; one that meets more sorts its other rows
SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 16 << 20  # what a task of a write reads at most, as it may have to group or sort all of it
MANY_FILES, SMALL_FILE = 4096, 4 << 20  # a write of more files than these, and smaller ones, is written again by folder
WORD, BLOCK = 64, 64 * 512  # rows of a file that a word, and an array of words, of replaced rows covers
MARKED_ROWS = 1 << 28  # rows whose marks are broadcast together: 32 MB


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for a while; its own holds again afterwards."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_UNITS = {"b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "": 0}


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Scans give a task ``SPLIT_BYTES`` at most, or less if the session says so."""
    number, unit = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(SPLIT).strip().lower()).groups()
    with setting(spark, SPLIT, str(min(int(number) << _UNITS[unit], SPLIT_BYTES))):
        yield


@contextmanager
def stamps_with_statistics(spark: SparkSession) -> Iterator[None]:
    """Writes timestamps as numbers, of which files keep the least and greatest per row group.

    A filter above a high-water mark then skips row groups without reading them.
    """
    with setting(spark, STAMP_TYPE, "TIMESTAMP_MICROS"):
        yield


def _now() -> int:
    """Microseconds since 1970, by the driver's clock (which also stamps ingested rows)."""
    return time.time_ns() // 1000


class EmptyPublication(ValueError):
    """A publication without rows; the current version stays."""


class WriteConflict(RuntimeError):
    """Another writer committed since this one read the table; nothing was changed."""


class LakeTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), tuple(partition_by)

    # --- state ---------------------------------------------------------------
    def log(self) -> DataFrame:
        """Commits and refused publications, one row each."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).json(f"{literal(self.path)}/_commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def _state(self) -> tuple[Row | None, int]:
        """Newest published commit and the next free version number, in one small job."""
        entry = F.when(F.col("estado") == "PUBLISHED", F.col("version"))
        found = self.log().agg(F.max("version").alias("last"), F.max_by(F.struct("*"), entry).alias("current")).first()
        return found.current, (found.last or 0) + 1

    def current(self) -> Row | None:
        return self._state()[0]

    def exists(self) -> bool:
        return self.current() is not None

    def has_batch(self, origin: str) -> bool:
        return not self.log().filter((F.col("origen") == origin) & (F.col("estado") == "PUBLISHED")).isEmpty()

    def read(self) -> DataFrame:
        state = self.current()
        if state is None:
            raise FileNotFoundError(f"no version of {self.path} has been published")
        return self._rows([c.ruta for c in state.carpetas], T.StructType.fromJson(json.loads(state.esquema)))

    def read_since(self, mark: datetime | None) -> DataFrame:
        """Current rows of folders whose merge began after a moment (everything without one).

        With one writer at a time, a merge begins after every row of the merges before
        it was ingested.  So rows ingested after ``mark``, the newest time among rows
        already taken, are all here, next to older rows that such a merge rewrote.  The
        caller still filters rows, which skips row groups by their statistics; this keeps
        the scan off folders that did not change, whose footers need not be opened.
        """
        if mark is None:
            return self.read()
        later = self.log().filter(F.col("momento") > F.unix_micros(F.lit(mark).cast("timestamp")))
        versions = {f"version={r.version}" for r in later.select("version").collect()}  # one row per commit
        state = self.current()
        folders = [c.ruta for c in state.carpetas if c.ruta.split("/")[0].split("-")[0] in versions]
        return self._rows(folders, T.StructType.fromJson(json.loads(state.esquema)))

    def version(self) -> int:
        """The newest published version, 0 before the first."""
        state = self.current()
        return state.version if state is not None else 0

    def changed_since(self, version: int) -> list[DataFrame]:
        """Rows of the folders that the table lost and of those it gained since a version.

        Folders that were only carried over are not read.  Rows that were rewritten with
        others of their folder are among both.
        """
        states = {r.version: r for r in self.log().filter((F.col("estado") == "PUBLISHED") & (F.col("version") == version)).collect()}
        before, now = states.get(version), self.current()
        folders = [{c.ruta for c in s.carpetas} if s is not None else set() for s in (before, now)]
        return [self._rows(sorted(some - other), T.StructType.fromJson(json.loads(s.esquema)))
                for s, some, other in zip((before, now), folders, reversed(folders)) if some - other]

    def folders(self) -> DataFrame:
        """(carpeta, filas): the folders of the current version; the same name means untouched files."""
        state = self.current()
        found = [(c.ruta, c.filas) for c in state.carpetas] if state is not None else []
        return self.spark.createDataFrame(found, "carpeta string, filas bigint")

    # --- changes -------------------------------------------------------------
    def publish(self, df: DataFrame, origin: str = "") -> int:
        """Replace the table's contents; refuse (and say so in the log) when there are no rows."""
        began, (_, version) = _now(), self._state()
        written = self._write(df, version, "all")
        if not written:
            self._commit(version, {}, df.schema, origin, began, "REFUSED")
            raise EmptyPublication(f"nothing to publish in {self.path}")
        self._commit(version, written, df.schema, origin, began)
        return sum(written.values())

    def replace(self, df: DataFrame, values: Sequence[str | None], origin: str = "") -> int:
        """Replace the rows of some values of the (one) partition column; all other folders are carried over by name."""
        began, (state, version) = _now(), self._state()
        (column,) = self.partition_by
        written = self._write(df, version, "part")
        names = {f"{column}={NULL_FOLDER if v is None else v}" for v in values}
        kept = {c.ruta: c.filas for c in state.carpetas if unquote(c.ruta.rsplit("/", 1)[-1]) not in names} if state is not None else {}
        schema = df.schema
        if state is not None:
            old = T.StructType.fromJson(json.loads(state.esquema))
            schema = T.StructType(old.fields + [f for f in schema.fields if f.name not in old.names])
        if not written and not kept:
            raise EmptyPublication(f"nothing to publish in {self.path}")
        self._commit(version, kept | written, schema, origin, began)
        return sum(written.values())

    def upsert(self, batch: DataFrame, keys: Sequence[str], origin: str = "") -> int:
        """Merge a batch with unique keys; returns the number of rows it brought (see ``upsert_folders``)."""
        return sum(self.upsert_folders(batch, keys, origin).values())

    def upsert_folders(self, batch: DataFrame, keys: Sequence[str], origin: str = "") -> dict[str, int]:
        """Merge a batch with unique keys; returns the rows it brought per partition folder.

        The batch is written once.  Only folders holding a key of the batch are
        read in full and rewritten, unless the batch replaces all of its rows; all others are carried over by name.  An
        ``origin`` that was merged before is skipped, so a retried batch is harmless.
        """
        if origin and self.has_batch(origin):
            return {}
        began, (state, version) = _now(), self._state()
        old = T.StructType.fromJson(json.loads(state.esquema)) if state is not None else None
        if old is not None and (absent := [k for k in keys if k not in old.names]):
            raise ValueError(f"{self.path} has no key column {absent}; its rows could not be found again")
        brought = self._write(batch, version, "new")
        if not brought:
            return {}
        schema, folders = batch.schema, dict(brought)
        if state is not None:
            schema = T.StructType(old.fields + [f for f in schema.fields if f.name not in old.names])
            arrived = self._rows(list(brought), batch.schema)
            before = {c.ruta: c.filas for c in state.carpetas}
            found = self._rows_with_keys(list(before), old, arrived, keys)
            few = sum(brought.values()) < sum(before.values())  # not all rows can be replaced: where they are will be needed
            found = self._noted(found, version) if few else found
            touched = self._by_folder(found)
            partly = {c: before[c] for c, n in touched.items() if n < before[c]}  # of the others every row is replaced
            if partly and not few:
                found = self._noted(self._rows_with_keys(list(partly), old, arrived, keys), version)
            for survivors in self._survivors(partly, old, found):
                folders |= self._write(survivors, version, "kept")
            folders |= {c: n for c, n in before.items() if c not in touched}
        self._commit(version, folders, schema, origin, began)
        return brought

    def append(self, rows: DataFrame, origin: str = "") -> int:
        """Add rows without looking at the ones that are there; nothing for an ``origin`` that was added before."""
        return sum(self.upsert_folders(rows, (), origin).values())

    @property
    def new_folders(self) -> str:
        """A pattern of the folders that batches bring; what a merge rewrites next to them is not among them."""
        return f"{literal(self.path)}/version=*.new"

    def committed(self, folders: Sequence[str]) -> list[str]:
        """Those of some version folders that a commit names.

        A folder of a later version than the newest commit may still be committed: it is an error to ask for it.
        """
        names = self.log().filter("estado = 'PUBLISHED'").select(F.explode("carpetas.ruta").alias("ruta"))
        known = {r.v for r in names.select(F.split("ruta", "/")[0].alias("v")).distinct().collect()}  # one row a version folder
        newest = self.version()
        if early := [f for f in folders if f not in known and int(f.split("=")[1].split("-")[0]) > newest]:
            raise WriteConflict(f"{self.path}: {early} are not committed yet")
        return [f for f in folders if f in known]

    # --- files ---------------------------------------------------------------
    def _rows(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*[literal(f"{self.path}/{f}") for f in folders]).select(*[f"`{c}`" for c in schema.names])

    def _write(self, df: DataFrame, version: int, what: str) -> dict[str, int]:
        """Write, then count what is really there: folder -> rows (footers only).

        Rows are written by the tasks that have them, which adaptive execution gives the advisory size; a task
        writes its folders side by side, without sorting its rows by folder.  Only where that gives a multitude of small files, as
        tasks have rows of many folders each, they are read again and each folder gets a few files of the advisory size.
        """
        written, files, size = self._put(df, version, what)
        if self.partition_by and files > max(MANY_FILES, 2 * len(written)) and size < files * SMALL_FILE:
            written, _, _ = self._put(self._rows(list(written), df.schema).hint("rebalance", *self.partition_by), version, what)
        return written

    def _put(self, df: DataFrame, version: int, what: str) -> tuple[dict[str, int], int, int]:
        """One new folder with a frame: folder -> rows, the number of files and their bytes."""
        folder = f"version={version}-{uuid.uuid4().hex}.{what}"
        writer = df.write.partitionBy(*self.partition_by) if self.partition_by else df.write
        with ExitStack() as settings:
            settings.enter_context(stamps_with_statistics(self.spark))
            settings.enter_context(small_splits(self.spark))
            settings.enter_context(setting(self.spark, OPEN_WRITERS, str(OPEN_FOLDERS)))
            writer.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(df.schema).option("basePath", self.path).parquet(literal(f"{self.path}/{folder}"))
        per_file = written.groupBy(F.col("_metadata.file_path").alias("_archivo"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("filas"))
        per_folder = per_file.groupBy(F.regexp_extract("_archivo", FOLDER, 1).alias("carpeta")).agg(
            F.sum("filas").alias("filas"), F.count("*").alias("archivos"), F.sum("bytes").alias("bytes"))
        found = per_folder.collect()  # one row per partition folder
        return {r.carpeta: r.filas for r in found}, sum(r.archivos for r in found), sum(r.bytes for r in found)

    def _places(self, folders: Sequence[str], schema: T.StructType, columns: Sequence[str]) -> DataFrame:
        """Columns of folders with the file and the place there of every row."""
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*[literal(f"{self.path}/{f}") for f in folders]).select(
            *[f"`{c}`" for c in columns], F.col("_metadata.file_path").alias("_archivo"), F.col("_metadata.row_index").alias("_fila"))

    def _rows_with_keys(self, folders: Sequence[str], schema: T.StructType, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        """(_archivo, _fila) of the rows whose key the batch carries, from a scan of the key columns only."""
        if not keys:
            return self.spark.createDataFrame([], "_archivo string, _fila bigint")
        here, incoming = _with_packed_key(self._places(folders, schema, keys), keys), _with_packed_key(batch.select(*[f"`{k}`" for k in keys]), keys)
        return in_batch(here, incoming, incoming.columns).select("_archivo", "_fila")

    def _noted(self, places: DataFrame, version: int) -> DataFrame:
        """Places of rows, written once."""
        path = f"{self.path}/_found/{version}-{uuid.uuid4().hex}"
        places.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(places.schema).parquet(literal(path))

    @staticmethod
    def _by_folder(places: DataFrame) -> dict[str, int]:
        """Rows per partition folder."""
        files = places.groupBy("_archivo").agg(F.count("*").alias("filas"))
        hit = files.groupBy(F.regexp_extract("_archivo", FOLDER, 1).alias("carpeta")).agg(F.sum("filas").alias("filas"))
        return {r.carpeta: r.filas for r in hit.collect()}  # at most one row per partition folder

    def _survivors(self, folders: dict[str, int], schema: T.StructType, found: DataFrame) -> Iterator[DataFrame]:
        """Rows of folders that are not among those found, as frames of which each is read and filtered without a shuffle.

        Only the marks of rows travel, a bit a row; those of ``MARKED_ROWS`` rows are broadcast at a time.
        """
        if not folders:
            return
        marks, rows = _marks(found.filter(F.regexp_extract("_archivo", FOLDER, 1).isin(*folders))), self._places(list(folders), schema, schema.names)
        for files in self._portions(folders, rows):
            here, marked = (rows, marks) if files is None else (rows.filter(F.col("_archivo").isin(*files)), marks.filter(F.col("_de").isin(*files)))
            word = F.col("_bits")[F.expr(f"cast(_fila % {BLOCK} div {WORD} as int)")]
            replaced = F.getbit(word, (F.col("_fila") % WORD).cast("int")) == 1
            met = here.join(F.broadcast(marked), (F.col("_archivo") == F.col("_de")) & (F.expr(f"_fila div {BLOCK}") == F.col("_bloque")), "left")
            yield met.filter(~F.coalesce(replaced, F.lit(False))).select(*[f"`{c}`" for c in schema.names])

    @staticmethod
    def _portions(folders: dict[str, int], rows: DataFrame) -> list[list[str] | None]:
        """Files whose rows are marked together; None for all of them."""
        if sum(folders.values()) <= MARKED_ROWS:
            return [None]
        portions, held = [[]], 0
        for r in rows.groupBy("_archivo").agg(F.count("*").alias("filas")).orderBy("_archivo").collect():  # one row a file, from footers
            if portions[-1] and held + r.filas > MARKED_ROWS:
                portions, held = [*portions, []], 0
            portions[-1].append(r._archivo)
            held += r.filas
        return portions

    def _commit(self, version: int, folders: dict[str, int], schema: T.StructType, origin: str,
                began: int, status: str = "PUBLISHED") -> None:
        pieces = json.dumps([{"ruta": c, "filas": n} for c, n in sorted(folders.items())])
        entry = self.spark.range(0, 1, 1, 1).select(
            F.lit(version).alias("version"), F.lit(sum(folders.values())).alias("filas"),
            F.from_json(F.lit(pieces), "array<struct<ruta:string,filas:bigint>>").alias("carpetas"),
            F.lit(schema.json()).alias("esquema"), F.lit(origin).alias("origen"), F.lit(status).alias("estado"),
            F.lit(began).alias("momento"))
        if self._state()[1] != version:
            raise WriteConflict(f"{self.path} changed while version {version} was being made")
        try:  # one folder per version: of two writers that come this far together, the later one fails
            entry.write.mode("errorifexists").json(f"{self.path}/_commits/{version}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise WriteConflict(f"{self.path} changed while version {version} was being made") from e


def _with_packed_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The record hash, if it is a key, as half as many bytes; a text that is none stays beside it."""
    if fv.RECORD_HASH not in keys or df.schema[fv.RECORD_HASH].dataType != T.StringType():
        return df
    told = [packed_hash(fv.RECORD_HASH).alias("_hash"), loose_hash(fv.RECORD_HASH).alias("_otra")]
    return df.select(*[f"`{c}`" for c in df.columns if c != fv.RECORD_HASH], *told)


def _marks(places: DataFrame) -> DataFrame:
    """(_de, _bloque, _bits): for a block of a file an array of words, with a bit set for every row that is named."""
    bit = F.expr(f"shiftleft(1L, cast(_fila % {WORD} as int))")
    dealt = places.withColumn("_bloque", F.expr(f"_fila div {BLOCK}")).repartition("_archivo", "_bloque")
    words = dealt.groupBy("_archivo", "_bloque", F.expr(f"cast(_fila % {BLOCK} div {WORD} as int)").alias("_palabra")).agg(F.bit_or(bit).alias("_bits"))
    known = words.groupBy("_archivo", "_bloque").agg(F.map_from_entries(F.collect_list(F.struct("_palabra", "_bits"))).alias("_de_palabra"))
    all_words = F.expr(f"transform(sequence(0, {BLOCK // WORD - 1}), w -> coalesce(_de_palabra[w], 0L))")
    return known.select(F.col("_archivo").alias("_de"), "_bloque", all_words.alias("_bits"))
