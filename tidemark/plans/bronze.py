"""Bronze: land a year's files of one domain.

All files of one table and month form a batch; all batches of a table, whatever their
formats, are parsed once, validated in one pass and merged in one upsert, so the latest month wins.
A bad file is logged as FAILED and the others go on; the caller decides whether to raise.
A line that does not fit its file is no reason to refuse the file: it is kept, with the reason,
in the domain's table of rejected lines, counted in the log, and the other lines are loaded.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidemark import fixed_values as fv
from tidemark.contracts import TableContract, is_known
from tidemark.functions.columns import in_month
from tidemark.operators.dedup import keyed_batch
from tidemark.plans.settings import Settings
from tidemark.sources import audit
from tidemark.sources.landing import classify, in_load_order, list_files
from tidemark.sources.readers import REJECT_REASON, REJECTED_LINE, conform, csv_headers, file_columns, header_cells, json_keys, lost_cells, read_batch
from tidemark.sources.tables import LakeTable
from tidemark.workspace import stage

PARTITIONS = (fv.SOURCE_YEAR, fv.SOURCE_MONTH)
# rows of a file of parsed lines: keys and repeated paths take few bytes, so that a split of the usual size would hold many millions of rows
FILE_ROWS = 1 << 18


class Rejected(ValueError):
    """A batch that may not be loaded."""


def with_origin(df: DataFrame, area: str, year: str, month: str | None, mode: str) -> DataFrame:
    """Technical columns; file path and name come from the scan itself."""
    return df.withColumns({
        fv.AREA: F.lit(area),
        fv.SOURCE_YEAR: F.lit(year),
        fv.SOURCE_MONTH: F.lit(month).cast("string"),
        fv.LOAD_MODE: F.lit(mode),
        fv.INGESTED_AT: F.current_timestamp(),
    })


def off_month(expected: str | Column) -> Column:
    """A month key that is there but names another month."""
    return F.col(fv.MONTH).isNotNull() & ~in_month(fv.MONTH, expected)


def month_violations(df: DataFrame, expected: str | Column) -> DataFrame:
    """Month keys that do not belong to the folder, with their rows."""
    return df.filter(off_month(expected)).groupBy(fv.MONTH).agg(F.count("*").alias("filas"))


@dataclass(frozen=True)
class Batch:
    """The files of one table, month and format; month is None for a full load."""

    table: str
    month: str | None
    mode: str
    fmt: str | None
    paths: tuple[str, ...]


File = tuple[Batch, str]
# columns of the table of rejected lines
REJECTS = """
area string, table_name string, source_year string, source_month string, source_path string, source_file_name string,
line string, reason string, rejected_at timestamp
"""


@dataclass
class Outcome:
    status: str
    rows: int | None = None
    message: str | None = None


def check_columns(table: str, contract: TableContract | None, columns: Sequence[str]) -> None:
    if contract and (missing := contract.missing(columns)):
        raise Rejected(f"{table}: columns {missing} are missing; found {list(columns)}")


def plain_path(path: str) -> str:
    """A path the way listings and scans both give it, whatever slashes follow the scheme."""
    return re.sub("^file:/+", "/", path).rstrip("/")


def owner(path: str, landed: Mapping[str, File]) -> File:
    """The landed file a path belongs to: itself or the folder of part files it lies in."""
    at = plain_path(path)
    while at not in landed:
        at, _, last = at.rpartition("/")
        if not at or not last:
            raise Rejected(f"{path} lies in none of the landed paths")
    return landed[at]


def headers_of(spark: SparkSession, files: Sequence[File]) -> dict[File, set[tuple[str, ...]]]:
    """The header lines of CSV files (several where a landed path is a folder), from one pass over all of them."""
    landed = {plain_path(p): (b, p) for b, p in files}
    found: dict[File, set[tuple[str, ...]]] = {f: set() for f in files}
    for row in csv_headers(spark, [p for _, p in files]).collect():  # file names and their header lines
        found[owner(row.path, landed)].add(header_cells(row.line))
    return found


def columns_of(spark: SparkSession, contract: TableContract | None, file: File, headers: set[tuple[str, ...]]) -> list[str]:
    """The columns a file brings; an error if they are not those of one table, or not the contract's."""
    b, path = file
    if b.fmt not in fv.FORMATS:
        raise Rejected(f"{b.table}: format {b.fmt} is not supported; expected one of {', '.join(fv.FORMATS)}")
    if b.fmt == "csv":
        if len(headers) > 1:
            raise Rejected(f"{b.table}: its parts have {len(headers)} different headers")
        columns = list(next(iter(headers), ()))
        if len({c.lower() for c in columns}) < len(columns) or "" in columns:
            raise Rejected(f"{b.table}: columns without a name of their own in {columns}")
    else:
        # a line of JSON names its own columns: the contract's are asked for, and none can be missing from a file
        columns = contract.column_names if contract and b.fmt == "json" else file_columns(spark, b.fmt, [path])
    check_columns(b.table, contract, columns)
    if not columns:
        raise Rejected(f"{b.table}: no rows")
    return columns


def open_files(spark: SparkSession, settings: Settings, contract: TableContract | None, batches: Sequence[Batch],
               each: bool) -> tuple[list[DataFrame], dict[File, Outcome]]:
    """A table's rows as text with technical columns, one scan per batch and header, and the files without the contract's columns.

    Without ``each`` all CSV files are taken to have the header of the first one, which the scan checks.
    """
    refused: dict[File, Outcome] = {}
    by_header: dict[tuple[Batch, tuple[str, ...]], list[str]] = {}
    texts = [(b, p) for b in batches for p in b.paths if b.fmt == "csv"]
    headers: dict[File, set[tuple[str, ...]]] = {}
    if texts and each:
        headers = headers_of(spark, texts)
    elif texts:
        first = tuple(file_columns(spark, "csv", [p for _, p in texts]))
        headers = {f: {first} for f in texts}
    for b in batches:
        for p in b.paths:
            try:
                by_header.setdefault((b, tuple(columns_of(spark, contract, (b, p), headers.get((b, p), set())))), []).append(p)
            except Exception as e:  # noqa: BLE001  an unreadable file is an outcome, not the end of the run
                refused[b, p] = Outcome(fv.FAILED, message=str(e))
    frames = []
    for (b, columns), paths in by_header.items():
        raw = read_batch(spark, b.fmt, paths, columns)
        if contract:
            raw = raw.select(*[f"`{c}`" for c in contract.column_names], fv.SOURCE_PATH, fv.SOURCE_FILE, REJECTED_LINE, REJECT_REASON)
        frames.append(with_origin(raw, settings.domain, settings.year, b.month, b.mode))
    return frames, refused


def parse(spark: SparkSession, settings: Settings, contract: TableContract | None,
          batches: Sequence[Batch]) -> tuple[DataFrame | None, dict[File, Outcome]]:
    """A table's files, parsed once and written, and the files that could not be opened.

    Files mostly share a header, which the scan checks in every one.  Only where that fails, all header
    lines are read first and files with one header are scanned together.
    """
    for each in (False, True):
        opened, refused = open_files(spark, settings, contract, batches, each)
        if not each and any(b.fmt == "csv" for b, _ in refused):
            continue
        try:
            return (stage(_together(opened), "landed-rows", FILE_ROWS) if opened else None), refused
        except Exception:  # noqa: BLE001  some header may be another one
            if each or not any(b.fmt == "csv" for b in batches):
                raise
    raise AssertionError("the second attempt returns or raises")


def inspect(raw: DataFrame, contract: TableContract | None) -> list[Row]:
    """Per file, from one pass over all batches of a table: rows, rejected lines, rows of another month and cells lost to casts.

    Counts alone, so that no task has to sort its rows for them (see ``strays``).
    """
    fits = F.col(REJECTED_LINE).isNull()
    lost = lost_cells(raw, contract) if contract else []
    cells = F.struct(*lost) if lost else F.lit(None)
    empty = [F.count_if(fits & F.col(f"`{c}`").isNotNull()) for c in (contract.column_names if contract else [])]
    per_file = raw.groupBy(fv.SOURCE_PATH).agg(
        F.count_if(fits).alias("rows"), F.count_if(~fits).alias("rejected"), F.count_if(_stray(raw)).alias("off"),
        cells.alias("lost"), F.array(*empty).cast("array<bigint>").alias("filled"))
    return per_file.collect()  # one row per file


def _stray(raw: DataFrame) -> Column:
    """Is a row's month another one than its folder's?"""
    if fv.MONTH not in raw.columns:
        return F.lit(False)
    expected = F.concat(F.col(fv.SOURCE_YEAR), F.lit("-"), F.col(fv.SOURCE_MONTH))
    return F.col(REJECTED_LINE).isNull() & F.col(fv.SOURCE_MONTH).isNotNull() & off_month(expected)


def strays(raw: DataFrame) -> dict[str, tuple[str, str]]:
    """Per file with rows of another month: the first and the last such month."""
    months = raw.filter(_stray(raw)).select(fv.SOURCE_PATH, F.col(fv.MONTH).cast("string").alias("month")) \
        .distinct().filter("month is not null")
    found = months.groupBy(fv.SOURCE_PATH).agg(F.min("month").alias("first"), F.max("month").alias("last"))
    return {r[fv.SOURCE_PATH]: (r["first"], r["last"]) for r in found.collect()}  # at most one row per file


def reject_lines(spark: SparkSession, settings: Settings, table: str, raw: DataFrame) -> None:
    """Keep the lines that do not fit, with the reason."""
    lines = raw.filter(F.col(REJECTED_LINE).isNotNull()).select(
        F.lit(settings.domain).alias("area"), F.lit(table).alias("table_name"), F.lit(settings.year).alias("source_year"),
        F.col(fv.SOURCE_MONTH).alias("source_month"), F.col(fv.SOURCE_PATH).alias("source_path"), F.col(fv.SOURCE_FILE).alias("source_file_name"),
        F.col(REJECTED_LINE).alias("line"), F.col(REJECT_REASON).alias("reason"), F.col(fv.INGESTED_AT).alias("rejected_at"))
    LakeTable(spark, settings.rejects_path).append(lines)


def rejected_lines(spark: SparkSession, settings: Settings) -> DataFrame:
    """All lines of the domain's files that were not loaded because they do not fit; empty before the first."""
    kept = LakeTable(spark, settings.rejects_path)
    return kept.read() if kept.exists() else spark.createDataFrame([], REJECTS)


def load_table(spark: SparkSession, settings: Settings, contracts: dict[str, TableContract],
               batches: Sequence[Batch]) -> dict[File, Outcome]:
    """Validate a table's files together and merge the good ones in one upsert.

    Files are parsed once; one pass over what was parsed validates all months and one merge
    looks the keys up in the table, however many month folders and formats were landed.
    """
    table = batches[0].table
    files = [(b, p) for b in batches for p in b.paths]
    if not any(b.fmt in fv.FORMATS for b in batches) or is_known(table, contracts):
        contract = contracts.get(table)
    else:
        return {f: Outcome(fv.FAILED, message=f"{table} is not in the data dictionary") for f in files}
    raw, outcomes = parse(spark, settings, contract, batches)
    if raw is None:
        return outcomes
    landed = {plain_path(p): (b, p) for b, p in files if (b, p) not in outcomes}
    figures: dict[File, list[Row]] = {f: [] for f in landed.values()}
    for row in inspect(raw, contract):
        figures[owner(row[fv.SOURCE_PATH], landed)].append(row)
    if any(r.rejected for found in figures.values() for r in found):
        reject_lines(spark, settings, table, raw)

    doubtful = {f: names for f, found in figures.items() if f[0].fmt == "json" and contract and (
        names := [c for k, c in enumerate(contract.column_names) if not any(r.filled[k] for r in found)])}
    keys: dict[File, set[str]] = {f: set() for f in doubtful}
    for row in json_keys(spark, [p for _, p in doubtful]).collect() if doubtful else ():  # one row per file
        keys[owner(row.path, landed)].update(row["keys"])
    other_months = strays(raw) if any(r.off for found in figures.values() for r in found) else {}
    good: list[File] = []
    for (b, p), found in figures.items():
        rows, rejected, off = (sum(r[c] for r in found) for c in ("rows", "rejected", "off"))
        if not rows:
            outcomes[b, p] = Outcome(fv.FAILED, message=f"{table}: no rows" + (f" that fit; {rejected} lines rejected" if rejected else ""))
        elif (b, p) in keys and (gone := contract.missing(sorted(keys[b, p]))):
            outcomes[b, p] = Outcome(fv.FAILED, message=f"{table}: columns {gone} are missing")
        elif off:
            months = sorted({m for r in found for m in other_months.get(r[fv.SOURCE_PATH], ())})
            outcomes[b, p] = Outcome(fv.FAILED, message=f"{table}: {off} rows outside {settings.year}-{b.month}, such as {[months[0], months[-1]]}")
        else:
            good.append((b, p))
    if not good:
        return outcomes
    fit = raw.filter(F.col(REJECTED_LINE).isNull()).drop(REJECTED_LINE, REJECT_REASON)
    if len(good) < len(landed):
        paths = [(r[fv.SOURCE_PATH],) for f in good for r in figures[f]]
        fit = fit.join(spark.createDataFrame(paths, f"{fv.SOURCE_PATH} string"), fv.SOURCE_PATH, "left_semi")
    technical = [c for c in fit.columns if c.startswith("_tm_")]
    merged, key = keyed_batch(conform(fit, contract, keep=technical), contract.key if contract else fv.PRIMARY_KEYS.get(table, ()), technical)
    LakeTable(spark, settings.table_path("bronze", table), PARTITIONS).upsert(merged, key)
    for f in good:
        outcomes[f] = _loaded(figures[f])
    return outcomes


def _loaded(found: list[Row]) -> Outcome:
    """A loaded file's outcome: its rows, and what of it was not taken as it stood."""
    cells: Counter = Counter()
    for r in found:
        cells.update({c: n for c, n in r.lost.asDict().items() if n} if r.lost else {})
    rejected = sum(r.rejected for r in found)
    notes = [f"{rejected} lines rejected"] if rejected else []
    notes += [f"cells without an exact value: {dict(cells)}"] if cells else []
    return Outcome(fv.SUCCESS, sum(r.rows for r in found), "; ".join(notes) or None)


def _together(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_each(spark: SparkSession, settings: Settings, contracts: dict[str, TableContract],
              batches: Sequence[Batch]) -> dict[File, Outcome]:
    """Load a table's files together; if that fails, one by one, so that only the bad ones fail."""
    files = [(b, p) for b in batches for p in b.paths]
    try:
        return load_table(spark, settings, contracts, batches)
    except Exception as e:  # noqa: BLE001  a bad file is an outcome, not the end of the run
        if len(files) == 1:
            return {files[0]: Outcome(fv.FAILED, message=str(e))}
    outcomes: dict[File, Outcome] = {}
    for b, p in files:
        found = load_each(spark, settings, contracts, [replace(b, paths=(p,))])
        outcomes |= {(b, p): outcome for outcome in found.values()}
    return outcomes


def load_batches(spark: SparkSession, settings: Settings, contracts: dict[str, TableContract],
                 batches: Sequence[Batch]) -> DataFrame:
    """Load batches table by table; returns this run's log entries, one per file.

    A table's entries are stored as soon as it is done.
    """
    groups: dict[str, list[Batch]] = {}
    for b in batches:
        groups.setdefault(b.table, []).append(b)
    log_path, all_records = settings.log_path("bronze"), []
    for table, group in groups.items():
        records = [dict(
            load_id=str(uuid.uuid4()), area=settings.domain, table_name=table, load_mode=b.mode,
            source_year=settings.year, source_month=b.month, source_path=path,
            source_file_name=path.rsplit("/", 1)[-1], source_format=b.fmt or "",
            target_table=f"bronze.{settings.domain}.{table}", target_path=settings.table_path("bronze", table),
            record_count=outcome.rows, status=outcome.status, error_message=outcome.message,
            historic_path=settings.historic_path(b.month, path.rsplit("/", 1)[-1]))
            for (b, path), outcome in load_each(spark, settings, contracts, group).items()]
        audit.append(spark, log_path, audit.LOAD_LOG, records)
        all_records += records
    if not all_records:
        all_records = [dict(load_id=str(uuid.uuid4()), area=settings.domain, table_name=fv.NO_FILES, load_mode="no_data",
                            source_year=settings.year, source_path=settings.landing, source_file_name=fv.NO_FILES,
                            source_format="none", target_table="", target_path=log_path, record_count=0, status=fv.NO_DATA,
                            error_message="no files landed")]
        audit.append(spark, log_path, audit.LOAD_LOG, all_records)
    return audit.entries(spark, audit.LOAD_LOG, all_records)


def landed_batches(spark: SparkSession, settings: Settings) -> list[Batch]:
    """The landing zone as batches: all files of a table, month and format together, in load order."""
    listed = in_load_order(classify(list_files(spark, settings.landing), settings.landing))
    groups: dict[tuple, list[str]] = {}
    for f in listed.toLocalIterator():  # file names only
        groups.setdefault((f.tabla, f.mes, f.modo, f.formato), []).append(f.path)
    return [Batch(*key, tuple(paths)) for key, paths in groups.items()]


def load(spark: SparkSession, settings: Settings, contracts: dict[str, TableContract]) -> DataFrame:
    """Load everything landed for a domain and year; returns this run's log entries."""
    return load_batches(spark, settings, contracts, landed_batches(spark, settings))


def raise_on_failures(entries: DataFrame) -> None:
    bad = entries.filter(F.col("status") == fv.FAILED).select("source_file_name", "error_message")
    if total := bad.count():
        shown = "; ".join(f"{r.source_file_name}: {r.error_message}" for r in bad.take(10))
        raise Rejected(f"{total} files failed, such as {shown}")


def archive_plan(spark: SparkSession, settings: Settings) -> DataFrame:
    """Pending files of a domain and what becomes of each (the move itself is the file system's)."""
    log = audit.read(spark, settings.log_path("bronze"), audit.LOAD_LOG)
    return audit.archive_outcomes(audit.pending_archives(log), list_files(spark, settings.landing),
                                  list_files(spark, settings.historic))


def record_archive(spark: SparkSession, settings: Settings, outcomes: DataFrame) -> int:
    """Store the outcomes of an archive plan once its files were moved; returns the loads updated."""
    return audit.record_archive_outcomes(spark, settings.log_path("bronze"), outcomes)
