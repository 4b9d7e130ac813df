from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import types as T

from tidemark.contracts import TableContract
from tidemark.sources import audit
from tidemark.sources.landing import classify, in_load_order, list_files
from tidemark.sources.readers import conform, file_columns, read_batch, read_csv, read_dictionary

YEAR = "/lake/raw/comercial/2026"


def classified(spark, *paths):
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    return rows(classify(df, YEAR), "archivo", "tabla", "mes", "modo", "formato", "motivo_rechazo")


@pytest.mark.parametrize("path, expected", [
    ("01/fact_ventas_cabecera_01.csv", ("fact_ventas_cabecera", "01", "incremental", "csv", None)),
    ("01/fact_ventas_cabecera_02.csv", ("fact_ventas_cabecera_02", "01", "incremental", "csv", None)),
    ("12/fact_ventas.json", ("fact_ventas", "12", "incremental", "json", None)),
    ("12/fact_ventas_12.PARQUET", ("fact_ventas", "12", "incremental", "parquet", None)),
    ("dim_ciudad_01.csv", ("dim_ciudad_01", None, "full", "csv", None)),
    ("notas.xlsx", ("notas.xlsx", None, "full", "xlsx", "formato_no_soportado")),
    ("leeme", ("leeme", None, "full", None, "sin_extension"))])
def test_files_are_named_by_place_and_extension(spark, path, expected):
    (found,) = classified(spark, f"file:{YEAR}/{path}")
    assert found == (path.rsplit("/", 1)[-1], *expected)


def test_other_folders_are_not_part_of_the_zone(spark):
    assert classified(spark, f"{YEAR}/13/a.csv", f"{YEAR}/tmp/a.csv", f"{YEAR}/01/deep/a.csv", f"{YEAR}/1/a.csv") == []


def test_listing_of_a_missing_folder_is_empty(spark, folder):
    assert list_files(spark, folder).isEmpty()


def test_files_are_listed_in_load_order(spark, tmp_path):
    for p in ("02/b.csv", "01/z.csv", "01/a.csv", "full.csv"):
        f = tmp_path / p
        f.parent.mkdir(exist_ok=True)
        f.write_text("x\n1\n")
    found = in_load_order(classify(list_files(spark, str(tmp_path)), str(tmp_path))).collect()
    assert [r.archivo for r in found] == ["full.csv", "a.csv", "z.csv", "b.csv"]


CONTRACT = TableContract("t", (("id", "string"), ("n", "bigint"), ("x", "double")), ("id",))


def test_text_is_never_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,id,otra,n\n1.5,007,z,12\nmal,2026-01,z,3.0\n")
    raw = read_batch(spark, "csv", [str(tmp_path / "a.csv")])
    out = conform(raw, CONTRACT)
    assert out.columns == ["id", "n", "x"]
    assert rows(out) == [("007", 12, 1.5), ("2026-01", 3, None)]


def test_json_and_parquet_batches(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "007", "n": 1}\n{"id": "8", "x": 2.5}\n')
    path = str(tmp_path / "a.json")
    assert file_columns(spark, "json", [path]) == ["id", "n", "x"]
    assert rows(conform(read_batch(spark, "json", [path]), CONTRACT)) == [("007", 1, None), ("8", None, 2.5)]
    spark.createDataFrame([("1", 2, 3.0)], "id string, n int, x double").write.parquet(str(tmp_path / "p"))
    assert rows(conform(read_batch(spark, "parquet", [str(tmp_path / "p")]), CONTRACT)) == [("1", 2, 3.0)]
    with pytest.raises(ValueError):
        read_batch(spark, "xlsx", [path])


def test_a_header_that_differs_between_files_is_an_error_not_a_shift(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,2\n")
    (tmp_path / "b.csv").write_text("n,id\n1,2\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "n")])
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path), schema).collect()


def test_dictionary_keeps_the_order_of_its_lines(spark, tmp_path):
    (tmp_path / "d.csv").write_text("tabla,campo,tipo_dato_csv,rol\nt,z,object,PK\nt,a,int64,\n")
    found = read_dictionary(spark, str(tmp_path / "d.csv")).orderBy("posicion").collect()
    assert [r.campo for r in found] == ["z", "a"]


def test_logs(spark, folder):
    assert audit.read(spark, folder, audit.STEP_LOG).isEmpty()
    audit.append(spark, folder, audit.STEP_LOG, [])
    assert audit.read(spark, folder, audit.STEP_LOG).isEmpty()
    base = dict(environment="dev", domain_name="shared", table_name="t", input_rows=1, output_rows=1)
    first, second = datetime(2026, 1, 1), datetime(2026, 2, 1)
    audit.append(spark, folder, audit.STEP_LOG, [base | dict(step_name="s", status="SUCCESS", new_watermark=first)])
    audit.append(spark, folder, audit.STEP_LOG, [base | dict(step_name="s", status="FAILED", new_watermark=second),
                                                 base | dict(step_name="o", status="SUCCESS", new_watermark=second)])
    log = audit.read(spark, folder, audit.STEP_LOG)
    assert audit.high_water_mark(log, "s", "t") == first
    assert audit.high_water_mark(log, "s", "u") is None
    assert audit.step_summary(log).columns[0] == "step_name" and log.count() == 3
    with pytest.raises(ValueError):
        audit.entries(spark, audit.STEP_LOG, [{"nada": 1}])


def test_archive_round_is_idempotent(spark):
    loads = [dict(load_id=i, area="a", table_name="t", load_mode="full", source_year="2026", source_path=f"raw/{i}",
                  source_file_name=i, source_format="csv", target_table="t", target_path="t", status="SUCCESS",
                  historic_path=f"hist/{i}") for i in "abc"]
    log = audit.entries(spark, audit.LOAD_LOG, loads + [loads[0] | dict(load_id="d", status="FAILED")])
    landed = spark.createDataFrame([("raw/a",)], "path string")
    historic = spark.createDataFrame([("hist/b",)], "path string")
    out = audit.archive_outcomes(audit.pending_archives(log), landed, historic)
    assert rows(out, "load_id", "archive_status", "por_mover") == \
        [("a", "SUCCESS", True), ("b", "SUCCESS", False), ("c", "FAILED", False)]
    stamp = datetime(2026, 3, 1)
    updates = spark.createDataFrame([("a", stamp, "SUCCESS", None, stamp), ("zz", stamp, "SUCCESS", None, stamp)],
                                    "load_id string, archived_at timestamp, archive_status string, "
                                    "archive_error_message string, updated_at timestamp")
    after = audit.apply_archive_updates(log, updates)
    assert rows(audit.pending_archives(after), "load_id") == [("b",), ("c",)]
    assert rows(audit.apply_archive_updates(after, updates)) == rows(after)
