"""What a task has to hold when files are loaded: cells, not the texts that are the same in all rows of a file."""

from datetime import datetime
from pathlib import Path

from conftest import rows
from pyspark.sql import DataFrameWriter, functions as F

from tidemark import fixed_values as fv
from tidemark.contracts import TableContract
from tidemark.operators import dedup
from tidemark.plans import bronze
from tidemark.plans.settings import Settings
from tidemark.sources import tables
from tidemark.sources.tables import LakeTable

SCHEMA = f"k bigint, v string, {fv.AREA} string, {fv.SOURCE_YEAR} string, {fv.SOURCE_MONTH} string, {fv.LOAD_MODE} string, " \
         f"{fv.INGESTED_AT} timestamp, {fv.SOURCE_PATH} string, {fv.SOURCE_FILE} string"
ORIGIN = [fv.AREA, fv.SOURCE_YEAR, fv.SOURCE_MONTH, fv.LOAD_MODE, fv.INGESTED_AT, fv.SOURCE_PATH, fv.SOURCE_FILE]


def landed_rows(spark):
    files = [("a", "2026", m, mode, datetime(2026, 5, day), f"/raw/{m}/{name}", name)
             for m, mode, day in ((None, "full", 2), ("01", "incremental", 1), ("01", "incremental", 2), ("10", "incremental", 2))
             for name in ("x.csv", "é.csv")]
    cells = [(1, "a"), (1, "b"), (2, None), (None, "n"), (None, None), (3, "c")]
    return spark.createDataFrame([(k, v, *f) for i, f in enumerate(files) for k, v in cells if k != 2 or i % 3 == 0], SCHEMA)


def nodes(plan, name):
    found = [plan] if plan.nodeName() == name else []
    for i in range(plan.children().size()):
        found += nodes(plan.children().apply(i), name)
    return found


def test_rows_are_deduplicated_without_the_texts_of_their_file(spark):
    df = landed_rows(spark)
    newest, key = dedup.keyed_batch(df, ["k"], ORIGIN)
    assert (newest.columns, key) == (df.columns, ["k"])
    assert rows(newest) == rows(dedup.latest_by_key(df, ["k"]))
    (window,) = nodes(newest._jdf.queryExecution().optimizedPlan(), "Window")
    assert "_origen" in window.output().mkString(",") and "_tm_" not in window.output().mkString(",")


def test_figures_of_files_sort_no_rows(spark, monkeypatch):
    plans = []
    parsed = landed_rows(spark).withColumns({
        fv.MONTH: F.when(F.col("k") == 3, "2026-11").when(F.col("k") == 1, "2026-07-01").otherwise(F.concat(F.lit("2026-"), fv.SOURCE_MONTH)),
        bronze.REJECTED_LINE: F.lit(None).cast("string")})
    contract = TableContract("t", (("k", "bigint"), ("v", "string"), (fv.MONTH, "string")), ("k",))

    collect = type(parsed).collect

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)
    monkeypatch.setattr(type(parsed), "collect", seen)
    found = {r[fv.SOURCE_PATH]: r for r in bronze.inspect(parsed, contract)}
    assert len(plans) == 1 and "HashAggregate" in plans[0] and "Sort" not in plans[0]
    assert (found["/raw/10/x.csv"].rows, found["/raw/10/x.csv"].off, found["/raw/None/x.csv"].off) == (6, 3, 0)
    assert bronze.strays(parsed) == {f"/raw/{m}/{n}": ("2026-07-01", "2026-11") for m in ("01", "10") for n in ("x.csv", "é.csv")}


def test_folders_are_written_without_sorting_rows_by_folder(spark, folder, monkeypatch):
    plain, seen = DataFrameWriter.parquet, []

    def parquet(self, *args, **kwargs):
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return plain(self, *args, **kwargs)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    many = spark.range(10_000).select("id", (F.col("id") % 40).cast("string").alias("part"))  # more folders than a task keeps open
    monkeypatch.setattr(tables, "OPEN_FOLDERS", 3)
    table = LakeTable(spark, folder, ("part",))
    table.publish(many)
    assert seen == ["3"] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert rows(table.read()) == rows(many)


def test_parsed_lines_are_read_in_files_of_bounded_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(bronze, "FILE_ROWS", 100)
    settings = Settings(folder, "comercial", "2026")
    file = Path(settings.landing) / "t.csv"
    file.parent.mkdir(parents=True)
    file.write_text("k,v\n" + "".join(f"{i},x\n" for i in range(1000)))
    contract = TableContract("t", (("k", "bigint"), ("v", "string")), ("k",))
    parsed, refused = bronze.parse(spark, settings, contract, [bronze.Batch("t", None, "full", "csv", (str(file),))])
    assert not refused and parsed.count() == 1000
    assert max(r["count"] for r in parsed.groupBy(F.col("_metadata.file_path")).count().collect()) == 100
