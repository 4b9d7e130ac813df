"""Files as users name and write them: odd names, lines that do not fit, many files."""

from pathlib import Path

import pytest
from conftest import rows

from tidemark import fixed_values as fv
from tidemark.contracts import TableContract
from tidemark.plans import bronze
from tidemark.plans.settings import Settings
from tidemark.sources.landing import list_files
from tidemark.sources.readers import csv_headers, header_cells, json_keys
from tidemark.sources.tables import LakeTable

CONTRACT = {"t": TableContract("t", (("id", "string"), ("n", "bigint")), ("id",))}


def landed(folder, **files):
    settings = Settings(folder, "comercial", "2026")
    month = Path(settings.landing) / "01"
    month.mkdir(parents=True)
    for name, text in files.items():
        (month / name).write_text(text, encoding="utf-8")
    return settings


def stored(spark, settings):
    return LakeTable(spark, settings.table_path("bronze", "t"), bronze.PARTITIONS).read()


NAMES = ["t x", "t%20x", "t+x", "tñé", "t[1]", "t{a,b}", "t,y", "t#1", "t'q"]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_files_of_any_name_are_loaded(spark, folder, fmt):
    def text(k):
        return f"id,n\n{k},1\n" if fmt == "csv" else f'{{"id": "{k}", "n": 1}}\n'
    settings = landed(folder, **{f"{name}.{fmt}": text(k) for k, name in enumerate(NAMES)})
    contracts = {name: TableContract(name, CONTRACT["t"].columns, ("id",)) for name in NAMES}
    log = bronze.load(spark, settings, contracts)
    assert rows(log, "source_file_name", "status", "record_count") == sorted(((f"{n}.{fmt}", fv.SUCCESS, 1) for n in NAMES), key=repr)
    for name in NAMES:
        found = LakeTable(spark, settings.table_path("bronze", name), bronze.PARTITIONS).read().first()
        assert found[fv.SOURCE_FILE] == f"{name}.{fmt}" and found[fv.SOURCE_PATH].endswith(f"/01/{name}.{fmt}")
    plan = bronze.archive_plan(spark, settings)
    assert plan.filter("por_mover").count() == len(NAMES) == plan.count()


def test_a_path_outside_the_landed_ones_is_an_error_not_a_loop():
    file = (bronze.Batch("t", None, "full", "csv", ("/a/b",)), "/a/b")
    assert bronze.owner("file:///a/b/part-0.csv", {"/a/b": file}) == file
    for path in ("/c/d.csv", "s3a://x/y", "", "relative"):
        with pytest.raises(bronze.Rejected):
            bronze.owner(path, {"/a/b": file})


def test_lines_that_do_not_fit_are_kept_apart(spark, folder):
    settings = landed(folder, **{
        "t.csv": 'id,n\na,1\nb\nc,2,EXTRA\n"d, d",3\n"e,4\n\nf,x\n',
        "t_01.csv": "id,n,otra\ng,7,z\nh,8\n",
        "t.json": '{"id": "i", "n": 9}\n{"id": "j", "n\nroto\n{"id": "k"}\n'})
    log = {r.source_file_name: r for r in bronze.load(spark, settings, CONTRACT).collect()}
    assert {k: (r.status, r.record_count) for k, r in log.items()} == {
        "t.csv": ("SUCCESS", 3), "t_01.csv": ("SUCCESS", 1), "t.json": ("SUCCESS", 2)}
    assert log["t.csv"].error_message == "3 lines rejected; cells without an exact value: {'n': 1}"
    assert log["t.json"].error_message == "2 lines rejected"
    assert rows(stored(spark, settings), "id", "n") == sorted([("a", 1), ("d, d", 3), ("f", None), ("g", 7), ("i", 9), ("k", None)], key=repr)
    assert rows(bronze.rejected_lines(spark, settings), "source_file_name", "line", "reason") == sorted([
        ("t.csv", "b", "2 cells expected, found 1"), ("t.csv", "c,2,EXTRA", "2 cells expected, found 3"),
        ("t.csv", '"e,4', "cells cannot be told apart"), ("t_01.csv", "h,8", "3 cells expected, found 2"),
        ("t.json", '{"id": "j", "n', "no JSON object"), ("t.json", "roto", "no JSON object")], key=repr)


def test_a_file_of_nothing_but_bad_lines_fails(spark, folder):
    settings = landed(folder, **{"t.csv": "id,n\na\nb\n", "t_01.csv": "id,n\n"})
    assert bronze.rejected_lines(spark, settings).isEmpty()
    log = {r.source_file_name: r for r in bronze.load(spark, settings, CONTRACT).collect()}
    assert {k: (r.status, r.error_message) for k, r in log.items()} == {
        "t.csv": ("FAILED", "t: no rows that fit; 2 lines rejected"), "t_01.csv": ("FAILED", "t: no rows")}
    assert bronze.rejected_lines(spark, settings).count() == 2


def test_headers_are_checked_by_name(spark, folder):
    settings = landed(folder, **{"t.csv": "﻿id,n\na,1\n", "t_01.csv": "\n\nn,id\n2,b\n", "t.CSV": "\n", "t.Csv": "id,n,ID\nc,3,d\n"})
    log = {r.source_file_name: r for r in bronze.load(spark, settings, CONTRACT).collect()}
    assert {k: r.status for k, r in log.items()} == {"t.csv": "SUCCESS", "t_01.csv": "SUCCESS", "t.CSV": "FAILED", "t.Csv": "FAILED"}
    assert "missing" in log["t.CSV"].error_message and "name of their own" in log["t.Csv"].error_message
    assert rows(stored(spark, settings), "id", "n") == [("a", 1), ("b", 2)]


def jobs(spark, name, act):
    spark.sparkContext.setJobGroup(name, name)
    try:
        act()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_number_of_jobs_does_not_grow_with_the_files(spark, tmp_path):
    def load(n):
        settings = Settings(str(tmp_path / f"lake{n}"), "comercial", "2026")
        month = Path(settings.landing) / "01"
        month.mkdir(parents=True)
        for i in range(n):
            header, line = (("id,n", f"{i},1") if i % 2 else ("n,id", f"1,{i}"))
            (month / f"t{'_01' if i == 0 else ''}.csv" if i < 2 else month / f"x{i}.csv").write_text(f"{header}\n{line}\n")
        batch = bronze.Batch("t", "01", "incremental", "csv", tuple(str(p) for p in sorted(month.iterdir())))
        log = []
        count = jobs(spark, f"load{n}", lambda: log.extend(bronze.load_batches(spark, settings, CONTRACT, [batch]).collect()))
        assert len(log) == n and {r.status for r in log} == {"SUCCESS"} and stored(spark, settings).count() == n
        return count
    few, many = load(5), load(200)
    assert many <= few + 8, (few, many)  # Spark lists more than 32 paths by a job for each reader


def test_files_of_one_header_are_read_once(spark, folder, monkeypatch):
    def never(*args):
        raise AssertionError("header lines were read")
    monkeypatch.setattr(bronze, "csv_headers", never)
    settings = landed(folder, **{"t.csv": "id,n\na,1\n", "t_01.csv": "id,n\nb,2\nc\n"})
    log = bronze.load(spark, settings, CONTRACT)
    assert rows(log, "source_file_name", "record_count") == [("t.csv", 1), ("t_01.csv", 1)]


def test_first_lines(spark, tmp_path):
    (tmp_path / "big.csv").write_text("\n \nid,n\n" + "".join(f"{i},{i}\n" for i in range(1000)))
    (tmp_path / "b.csv").write_text('"a, b",c\n1,2\n')
    found = csv_headers(spark, [str(tmp_path / x) for x in ("big.csv", "b.csv")]).collect()
    assert {r.path.rsplit("/", 1)[-1]: header_cells(r.line) for r in found} == {"big.csv": ("id", "n"), "b.csv": ("a, b", "c")}


def test_keys_of_json_files(spark, tmp_path):
    (tmp_path / "a b.json").write_text('{"x": 1}\n{"y": 2}\nroto\n')
    (found,) = json_keys(spark, [str(tmp_path / "a b.json")]).collect()
    assert found.path.endswith("/a b.json") and set(found["keys"]) == {"x", "y"}


def test_listings_and_scans_name_a_file_alike(spark, tmp_path):
    (tmp_path / "ñ %41+b.csv").write_text("id\n1\n")
    (path,) = [r.path for r in list_files(spark, str(tmp_path)).collect()]
    (header,) = csv_headers(spark, [path]).collect()
    assert bronze.plain_path(header.path) == bronze.plain_path(path)
