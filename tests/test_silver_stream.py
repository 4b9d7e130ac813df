"""The silver refresh as a stream."""

from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.plans import silver
from tidemark.plans.bronze import PARTITIONS
from tidemark.plans.settings import Settings
from tidemark.sources import audit
from tidemark.sources.tables import LakeTable, WriteConflict
from tidemark.streaming.silver import refresh_new_rows


def load(spark, settings, stamp, *rows_):
    batch = spark.createDataFrame(rows_, "ciudad_id string, ciudad string").withColumns({
        fv.SOURCE_YEAR: F.lit("2026"), fv.SOURCE_MONTH: F.lit("01"), fv.INGESTED_AT: F.lit(datetime(2026, 1, stamp)).cast("timestamp")})
    LakeTable(spark, settings.table_path("bronze", "dim_ciudad"), PARTITIONS).upsert(batch, ["ciudad_id"])


def stored(spark, settings):
    table = LakeTable(spark, settings.table_path("silver", "dim_ciudad"), PARTITIONS).read()
    return rows(table.drop(fv.SILVER_AT))


def logged(spark, settings):
    log = audit.read(spark, settings.log_path("silver"), audit.STEP_LOG)
    return rows(log, "step_name", "status", "input_rows", "output_rows", "new_watermark")


def stream(spark, settings):
    refresh_new_rows(spark, settings, "dim_ciudad", f"{settings.root}/checkpoint").awaitTermination()


WAVES = (1, ("1", " a "), ("2", "b")), (2, ("2", "B"), ("3", None)), (3, ("1", "A"))


def test_the_stream_does_what_the_batch_refresh_does(spark, tmp_path):
    streamed, batched = Settings(str(tmp_path / "s"), "comercial", "2026"), Settings(str(tmp_path / "b"), "comercial", "2026")
    for stamp, *wave in WAVES:
        for settings in (streamed, batched):
            load(spark, settings, stamp, *wave)
        stream(spark, streamed)
        silver.refresh(spark, batched, ["dim_ciudad"])
        assert stored(spark, streamed) == stored(spark, batched)
    assert logged(spark, streamed) == logged(spark, batched)


@pytest.mark.parametrize("lost", ["nothing", "log"])
def test_a_replayed_batch_changes_nothing_twice(spark, tmp_path, monkeypatch, lost):
    settings = Settings(str(tmp_path / "s"), "comercial", "2026")
    load(spark, settings, *WAVES[0])
    append = audit.append
    if lost == "log":  # the job dies between the merge and its log entries
        def fail(*args, **named):
            raise OSError("lost")
        monkeypatch.setattr(audit, "append", fail)
        with pytest.raises(Exception, match="lost"):
            stream(spark, settings)
        monkeypatch.setattr(audit, "append", append)
        assert logged(spark, settings) == [] and len(stored(spark, settings)) == 2
    else:  # the job dies before the checkpoint knows that the batch is done
        stream(spark, settings)
        for done in (Path(settings.root) / "checkpoint" / "commits").iterdir():
            done.unlink()
    versions = LakeTable(spark, settings.table_path("silver", "dim_ciudad")).version()
    stream(spark, settings)
    assert LakeTable(spark, settings.table_path("silver", "dim_ciudad")).version() == versions
    assert [r[1:4] for r in logged(spark, settings)] == [("SUCCESS", 2, 2)] * 4


def test_folders_without_a_commit(spark, tmp_path):
    settings = Settings(str(tmp_path / "s"), "comercial", "2026")
    load(spark, settings, *WAVES[0])
    table = LakeTable(spark, settings.table_path("bronze", "dim_ciudad"), PARTITIONS)
    rows_ = table.read()
    table._write(rows_.withColumn("ciudad", F.lit("x")), 1, "new")  # a writer that lost against version 1
    stream(spark, settings)
    assert {r.ciudad for r in LakeTable(spark, settings.table_path("silver", "dim_ciudad")).read().collect()} == {"a", "b"}
    table._write(rows_, 7, "new")  # not committed yet: the batch has to wait
    with pytest.raises(Exception, match="not committed yet"):
        stream(spark, settings)
    with pytest.raises(WriteConflict):
        table.committed(["version=9-x.new"])
