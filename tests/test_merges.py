import re

from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import DataFrameWriter, functions as F

from tidemark import fixed_values as fv
from tidemark.operators.dedup import distinct_records, keyed_batch, latest_by_hash, latest_by_key, with_hash_key
from tidemark.operators.upsert import keyed_upsert, update_only
from tidemark.sources import tables
from tidemark.sources.tables import EmptyPublication, LakeTable, WriteConflict

SCHEMA = "k long, v string, _tm_ingestion_ts timestamp, _tm_source_path string"


def at(day):
    return datetime(2026, 1, day)


def test_newest_row_wins_and_nulls_lose(spark):
    df = spark.createDataFrame([(1, "old", at(1), "z"), (1, "new", at(2), "a"), (2, "x", None, "b"), (2, "y", at(1), "a"),
                                (None, "p", at(1), "a"), (None, "q", at(1), "b")], SCHEMA)
    assert rows(latest_by_key(df, ["k"]), "k", "v") == [(1, "new"), (2, "y"), (None, "q")]


def test_ties_do_not_depend_on_row_order(spark):
    data = [(k, f"v{i}", at(1), "same") for k in range(20) for i in range(10)]
    once = rows(latest_by_key(spark.createDataFrame(data, SCHEMA).repartition(7), ["k"]))
    again = rows(latest_by_key(spark.createDataFrame(data[::-1], SCHEMA).repartition(3), ["k"]))
    assert once == again and len(once) == 20 and all(r[1] == "v9" for r in once)


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(90_000).select((F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))).alias("k"), F.col("id").alias("v"))
    out = latest_by_key(df, ["k"], newest=["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == 60_001
    assert out.filter("k = -1").first().v == 89_997


def test_hash_key_ignores_the_time_of_ingestion(spark):
    df = spark.createDataFrame([(1, "a", at(1), "f"), (1, "a", at(2), "f"), (1, "b", at(1), "f"), (1, None, at(1), "f")], SCHEMA)
    batch, key = keyed_batch(df, ())
    assert key == ["_tm_record_hash"] and batch.count() == 3
    assert rows(batch.filter("v = 'a'"), "_tm_ingestion_ts") == [(at(2),)]


def test_upsert_matches_null_keys_and_fills_missing_columns(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 30)], "k long, v string, old int")
    batch = spark.createDataFrame([(2, "B", True), (None, "N", False), (3, "C", True)], "k long, v string, new boolean")
    out = keyed_upsert(target, batch, ["k"])
    assert out.columns == ["k", "v", "old", "new"]
    assert rows(out) == [(1, "a", 10, None), (2, "B", None, True), (3, "C", None, True), (None, "N", None, False)]


def test_update_only_touches_named_columns_of_matches(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, s string")
    updates = spark.createDataFrame([("b", None, "Y"), ("c", 3, "Z")], "id string, n int, s string")
    assert rows(update_only(target, updates, "id", ["n"])) == [("a", 1, "x"), ("b", None, "y")]


batches = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("abc"), st.integers(1, 9)), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=batches, second=batches)
def test_upsert_properties(spark, first, second):
    """Keys stay unique, a repeated batch changes nothing, two batches equal their union."""
    def frame(data):
        return spark.createDataFrame([(k, v, at(d), "f") for k, v, d in data], SCHEMA)

    a, b = latest_by_key(frame(first), ["k"]), latest_by_key(frame([(k, v, d + 10) for k, v, d in second]), ["k"])
    merged = keyed_upsert(a, b, ["k"])
    assert rows(keyed_upsert(merged, b, ["k"])) == rows(merged)
    keys = [r[0] for r in rows(merged, "k")]
    assert len(keys) == len(set(keys))
    everything = frame(first + [(k, v, d + 10) for k, v, d in second])
    assert rows(latest_by_key(everything, ["k"])) == rows(merged)


def test_upsert_rewrites_only_folders_with_a_key_of_the_batch(spark, folder):
    t = LakeTable(spark, folder, ["m"])
    t.upsert(spark.createDataFrame([(1, "a", "01"), (2, "b", "02"), (3, "c", None)], "k long, v string, m string"), ["k"])
    t.upsert(spark.createDataFrame([(2, "B", "02"), (4, "d", "01")], "k long, v string, m string"), ["k"])
    assert rows(t.read()) == [(1, "a", "01"), (2, "B", "02"), (3, "c", None), (4, "d", "01")]
    state = t.current()
    kept = sorted(c.ruta for c in state.carpetas)
    assert any(re.fullmatch("version=1-.*new/m=01", k) for k in kept) and not any(re.fullmatch("version=1-.*new/m=02", k) for k in kept)
    assert state.filas == 4 and sum(c.filas for c in state.carpetas) == 4


def test_a_key_can_move_to_another_folder(spark, folder):
    t = LakeTable(spark, folder, ["m"])
    t.upsert(spark.createDataFrame([(1, "a", "01"), (2, "b", "01")], "k long, v string, m string"), ["k"])
    t.upsert(spark.createDataFrame([(1, "A", "02")], "k long, v string, m string"), ["k"])
    assert rows(t.read()) == [(1, "A", "02"), (2, "b", "01")]


def test_new_and_missing_columns_across_versions(spark, folder):
    t = LakeTable(spark, folder)
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), ["k"])
    t.upsert(spark.createDataFrame([(2, 7)], "k long, w long"), ["k"])
    t.upsert(spark.createDataFrame([(3, "c")], "k long, v string"), ["k"])
    assert t.read().columns == ["k", "v", "w"]
    assert rows(t.read()) == [(1, "a", None), (2, None, 7), (3, "c", None)]


def test_a_repeated_origin_and_an_empty_batch_change_nothing(spark, folder):
    t = LakeTable(spark, folder)
    first = spark.createDataFrame([(1, "a")], "k long, v string")
    assert t.upsert(first, ["k"], origin="b1") == 1
    assert t.upsert(spark.createDataFrame([(1, "z")], "k long, v string"), ["k"], origin="b1") == 0
    assert t.upsert(first.filter("k > 5"), ["k"]) == 0
    assert rows(t.read()) == [(1, "a")]


def test_an_empty_publication_keeps_the_current_version(spark, folder):
    t = LakeTable(spark, folder)
    with pytest.raises(FileNotFoundError):
        t.read()
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    assert t.publish(df) == 1
    with pytest.raises(EmptyPublication):
        t.publish(df.filter("k > 1"))
    assert rows(t.read()) == [(1, "a")]
    assert t.publish(spark.createDataFrame([(2.5,)], "otra double")) == 1
    assert rows(t.read()) == [(2.5,)] and t.read().columns == ["otra"]


def test_a_version_can_be_built_from_the_one_it_replaces(spark, folder):
    t = LakeTable(spark, folder)
    t.publish(spark.createDataFrame([(1,), (2,)], "k long"))
    t.publish(t.read().filter("k > 1"))
    assert rows(t.read()) == [(2,)]


def test_reading_since_a_moment_skips_unchanged_folders(spark, folder):
    t = LakeTable(spark, folder, ["m"])

    def arriving(*data):
        return spark.createDataFrame(data, "k long, m string").withColumn("ts", F.current_timestamp())

    t.upsert(arriving((1, "01"), (2, "02"), (3, "03")), ["k"])
    mark = t.read().agg(F.max("ts")).first()[0]
    assert t.read_since(mark).filter(F.col("ts") > F.lit(mark)).isEmpty()
    t.upsert(arriving((2, "02"), (4, "04")), ["k"])
    late = t.read_since(mark)
    assert rows(late.filter(F.col("ts") > F.lit(mark)), "k") == [(2,), (4,)]
    assert all("version=2" in f for f in late.inputFiles())
    assert rows(t.read_since(None), "k") == [(1,), (2,), (3,), (4,)]


def test_the_second_of_two_writers_is_refused(spark, folder, monkeypatch):
    first, second = LakeTable(spark, folder), LakeTable(spark, folder)
    first.publish(spark.createDataFrame([(1, "a")], "k int, v string"))
    state = second._state()
    first.upsert(spark.createDataFrame([(2, "b")], "k int, v string"), ["k"])
    real, calls = second._state, []

    def stale():  # the second writer read the table before the first one committed
        calls.append(1)
        return state if len(calls) == 1 else real()
    monkeypatch.setattr(second, "_state", stale)
    with pytest.raises(WriteConflict):
        second.upsert(spark.createDataFrame([(3, "c")], "k int, v string"), ["k"])
    assert sorted(r.k for r in first.read().collect()) == [1, 2]


def test_a_key_the_table_does_not_have_is_an_error(spark, folder):
    t = LakeTable(spark, folder)
    t.publish(spark.createDataFrame([(1, "a")], "k int, v string"))
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([(1, 1, "a")], "k int, other int, v string"), ["other"])


def test_equal_records_are_combined_before_the_shuffle(spark):
    df = spark.range(30).select(F.col("id") % 3, F.lit("a").alias("v"), F.lit(at(1)).cast("timestamp").alias(fv.INGESTED_AT))
    batch, _ = keyed_batch(df, ())
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("HashAggregate") == 2
    assert batch.count() == 3


def test_records_by_value_are_records_by_hash(spark):
    data = [(x, y, s, t) for x in (0.0, -0.0, float("nan"), 1.5, None) for y in (0.0, -0.0, None) for s in ("", None, "a") for t in (at(1), at(2), None)] * 2
    df = spark.createDataFrame(data, f"x double, `y.z` float, s string, {fv.INGESTED_AT} timestamp")
    batch, key = keyed_batch(df, ())
    told = latest_by_hash(with_hash_key(df))
    assert batch.columns == told.columns and repr(rows(batch)) == repr(rows(told)) and batch.count() == 45


def test_a_folder_whose_rows_are_all_replaced_is_not_read_again(spark, folder, monkeypatch):
    target = LakeTable(spark, folder, ["p"])
    target.upsert(spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", "x")], "k int, p string, v string"), ["k"])
    written, write = [], LakeTable._write
    monkeypatch.setattr(LakeTable, "_write", lambda self, df, version, what: written.append(what) or write(self, df, version, what))
    target.upsert(spark.createDataFrame([(1, "a", "y"), (2, "b", "y")], "k int, p string, v string"), ["k"])
    assert written == ["new"] and rows(target.read()) == [(1, "a", "y"), (2, "b", "y"), (3, "b", "x"), (4, "b", "x")]
    target.upsert(spark.createDataFrame([(3, "a", "z")], "k int, p string, v string"), ["k"])
    assert written == ["new", "new", "kept"] and rows(target.read(), "k", "v") == [(1, "y"), (2, "y"), (3, "z"), (4, "x")]


# --- what is shuffled and written by a merge

def plans_of(monkeypatch):
    """Plans of the frames that are written, as they are handed to the writer."""
    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append(self._df._jdf.queryExecution().executedPlan().toString())
        return plain(self, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_a_batch_is_written_where_it_was_deduplicated(spark, folder, monkeypatch):
    plans = plans_of(monkeypatch)
    rows_ = spark.range(1000).select((F.col("id") % 500).alias("id"), (F.col("id") % 2).cast("string").alias("m"), F.lit(at(1)).cast("timestamp").alias(fv.INGESTED_AT))
    batch, key = keyed_batch(rows_, ())
    LakeTable(spark, folder, ["m"]).upsert(batch, key)
    assert len(plans) == 1 and plans[0].count("Exchange") == 1  # that of the grouping, before the hash is there


def test_rows_that_stay_are_rewritten_without_a_shuffle(spark, folder, monkeypatch):
    target = LakeTable(spark, folder, ["m"])
    target.upsert(spark.range(1000).select("id", F.lit("x").alias("v"), (F.col("id") % 3).cast("string").alias("m")), ["id"])
    plans = plans_of(monkeypatch)
    target.upsert(spark.range(0, 1000, 7).select("id", F.lit("y").alias("v"), F.lit("0").alias("m")), ["id"])
    kept = plans[-1]
    assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in kept and "LeftAnti" not in kept
    assert rows(target.read(), "id", "v") == sorted([(i, "y" if i % 7 == 0 else "x") for i in range(1000)], key=repr)


@pytest.mark.parametrize("marked", [1 << 28, 150])
def test_rows_that_stay_are_right_however_they_are_portioned(spark, folder, monkeypatch, marked):
    monkeypatch.setattr(tables, "MARKED_ROWS", marked)
    monkeypatch.setattr(tables, "BLOCK", 128)  # several blocks a file
    target = LakeTable(spark, folder, ["m"])
    start = spark.range(0, 2000, 1, 3).select(F.nullif("id", F.lit(5)).alias("k"), F.lit("x y").alias("v"), (F.col("id") % 2).cast("string").alias("m"))
    target.upsert(start, ["k"])
    target.upsert(spark.range(0, 2000, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("new").alias("v"), F.lit("c").alias("m")), ["k"])
    wanted = [(k, "x y") for k in range(2000) if k != 5 and (k % 3 or k == 0)] + [(k or None, "new") for k in range(0, 2000, 3)]
    assert rows(target.read(), "k", "v") == sorted(wanted, key=repr)


def test_a_multitude_of_small_files_is_written_again(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "MANY_FILES", 8)
    target = LakeTable(spark, folder, ["m"])
    target.publish(spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 4).cast("string").alias("m")))
    assert len(target.read().inputFiles()) == 4 and target.read().count() == 1000


def test_texts_that_are_no_hash_are_told_as_they_are(spark, folder):
    ha, other = "ab" * 32, ["AB" * 32, "ab" * 31 + "a", "", "zz", None, "ab" * 33]
    target = LakeTable(spark, folder)
    made = spark.createDataFrame([(h, i) for i, h in enumerate([ha, *other])], f"{fv.RECORD_HASH} string, i int")
    target.upsert(made, [fv.RECORD_HASH])
    target.upsert(spark.createDataFrame([(ha, 10), ("", 11), (None, 12)], f"{fv.RECORD_HASH} string, i int"), [fv.RECORD_HASH])
    assert rows(target.read(), "i") == sorted([(i,) for i in (1, 2, 4, 6, 10, 11, 12)], key=repr)
    twice = made.unionByName(made).withColumn("k", F.col("i") % 2)
    assert rows(latest_by_key(twice, ["i"]), fv.RECORD_HASH, "i") == rows(made)


def test_the_hash_is_shuffled_as_bytes(spark):
    df = spark.range(10).select((F.col("id") % 5).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias(fv.RECORD_HASH))
    plan = latest_by_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    exchanged = plan[plan.index("Exchange"):]
    assert "unhex" in exchanged and "lower(hex(_hash" in plan[:plan.index("Exchange")]


def test_distinct_records_are_exact(spark, monkeypatch):
    data = [(m, h) for m, h in ((None, "a"), (None, "a"), (None, "b"), ("x", "a"), ("x", "c"), ("x", None), ("y", None)) for _ in range(2)]
    df = spark.createDataFrame([*data, ("z", "a"), ("z", "b")], f"m string, {fv.RECORD_HASH} string")
    wanted = sorted([(None, 2), ("x", 2), ("z", 2)], key=repr)
    assert rows(distinct_records(df, "m")) == wanted
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))  # all hashes share their bits
    assert rows(distinct_records(df, "m")) == wanted
