"""Figures observed while writing, filters that reach the files, references in one pass, products by month, late lookups."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.operators import quality
from tidemark.operators.rollup import Lake
from tidemark.plans import gold, silver
from tidemark.plans.bronze import PARTITIONS
from tidemark.plans.settings import Settings
from tidemark.sources import audit
from tidemark.sources.tables import STAMP_TYPE, EmptyPublication, LakeTable, stamps_with_statistics


def scans(df):
    """The file scans of a plan that has run, with their rows."""
    found = []

    def walk(p):
        if p.nodeName() == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if "QueryStage" in p.nodeName():
            return walk(p.plan())
        if p.nodeName().startswith("Scan parquet"):
            found.append((p.toString(), p.metrics().get("numOutputRows").get().value()))
        for i in range(p.children().size()):
            walk(p.children().apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_the_mark_reaches_the_files(spark, folder):
    table = LakeTable(spark, folder)
    for load in range(1, 5):
        table.append(spark.range(1000).withColumn(fv.INGESTED_AT, F.lit(datetime(2026, load, 1)).cast("timestamp")))
    fresh = silver.newer_than(table.read(), datetime(2026, 3, 1))
    assert len(fresh.collect()) == 1000
    ((shown, scanned),) = scans(fresh)
    assert "PushedFilters" in shown and f"GreaterThan({fv.INGESTED_AT}" in shown.replace(" ", "").replace("[", "") or "GreaterThan" in shown
    assert scanned < 4000


def test_the_session_keeps_its_own_setting(spark):
    before = spark.conf.get(STAMP_TYPE)
    with pytest.raises(ZeroDivisionError), stamps_with_statistics(spark):
        assert spark.conf.get(STAMP_TYPE) == "TIMESTAMP_MICROS"
        raise ZeroDivisionError
    assert spark.conf.get(STAMP_TYPE) == before


def bronze_rows(spark, rows_, schema, stamp):
    return spark.createDataFrame(rows_, schema).withColumns({
        fv.SOURCE_YEAR: F.lit("2026"), fv.SOURCE_MONTH: F.lit("01"), fv.INGESTED_AT: F.lit(stamp).cast("timestamp")})


def step_rows(log):
    return {r.step_name: (r.status, r.input_rows, r.output_rows) for r in log.collect()}


def test_steps_log_what_passed_them(spark, folder):
    settings = Settings(folder, "comercial", "2026")
    source = LakeTable(spark, settings.table_path("bronze", "dim_ciudad"), PARTITIONS)
    schema = "ciudad_id string, ciudad string"
    source.append(bronze_rows(spark, [("1", "a"), ("1", "b"), ("2", "c")], schema, datetime(2026, 1, 1)))
    first, *others = fv.STEPS
    assert step_rows(silver.refresh(spark, settings, ["dim_ciudad"])) == {first: ("SUCCESS", 3, 2), **{s: ("SUCCESS", 2, 2) for s in others}}
    # nothing new: the second run must not wait for figures that no plan has given
    assert step_rows(silver.refresh(spark, settings, ["dim_ciudad"])) == {s: ("NO_DATA", 0, 0) for s in fv.STEPS}
    target = LakeTable(spark, settings.table_path("silver", "dim_ciudad"), PARTITIONS)
    target.upsert(target.read().filter("ciudad_id = '2'").withColumn(fv.SILVER_STEP, F.lit(fv.STEPS[2])), ["ciudad_id"])
    source.append(bronze_rows(spark, [("3", "d")], schema, datetime(2026, 2, 1)))
    assert step_rows(silver.refresh(spark, settings, ["dim_ciudad"])) == {
        **{s: ("SUCCESS", 1, 1) for s in fv.STEPS[:3]}, fv.STEPS[3]: ("SUCCESS", 2, 2)}
    mark = audit.high_water_mark(audit.read(spark, settings.log_path("silver"), audit.STEP_LOG), first, "dim_ciudad")
    assert mark == datetime(2026, 2, 1)


def test_steps_of_an_empty_bronze_table(spark, folder):
    settings = Settings(folder, "comercial", "2026")
    LakeTable(spark, settings.table_path("bronze", "dim_ciudad"), PARTITIONS).append(
        bronze_rows(spark, [("1", "a")], "ciudad_id string, ciudad string", datetime(2026, 1, 1)))
    audit.append(spark, settings.log_path("silver"), audit.STEP_LOG, [dict(
        step_name=fv.STEPS[0], table_name="dim_ciudad", status=fv.SUCCESS, new_watermark=datetime(2026, 5, 1))])
    assert step_rows(silver.refresh(spark, settings, ["dim_ciudad"])) == {s: ("NO_DATA", 0, 0) for s in fv.STEPS}


# --- references

def test_references_in_one_pass_match_one_by_one(spark):
    tables = {
        "child": spark.createDataFrame([(1, "a", 1), (1, None, 2), (9, "x", 9), (9, "y", None), (None, "x", 7)], "p int, q string, self int"),
        "parent": spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "id int, name string"),
        "empty": spark.createDataFrame([], "id long")}
    references = [("child", "p", "parent", "id"), ("child", "q", "parent", "name"), ("child", "self", "parent", "id"),
                  ("child", "p", "child", "self"), ("child", "p", "empty", "id"), ("empty", "id", "parent", "id"), ("child", "q", "parent", "id")]
    one_by_one = [tuple(quality.reference_check(c, tables[c], col, p, tables[p], pc).first()) for c, col, p, pc in references[:-1]]
    together = [tuple(r) for r in quality.reference_checks(references, tables, tables).collect()]
    assert together[:-1] == one_by_one
    assert together[-1][:4] == ("child", "fk_q_to_parent_id", "ERROR", 3)  # texts that are no number are not found


def test_more_references_than_one_mark_holds(spark, monkeypatch):
    monkeypatch.setattr(quality, "TAGS", 2)
    wide = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, b int, c int, d int, e int")
    parent = spark.createDataFrame([(1,), (3,), (4,)], "id int")
    found = quality.reference_checks([("w", c, "p", "id") for c in "abcde"], {"w": wide}, {"p": parent})
    assert [r.failing_count for r in found.collect()] == [0, 1, 0, 0, 1]


def test_references_are_one_grouping(spark):
    parent = spark.range(10).withColumnRenamed("id", "pk")
    child = spark.range(100).selectExpr("id as a", "id + 1 as b", "id + 2 as c")
    checks = quality.reference_checks([("t", c, "p", "pk") for c in "abc"], {"t": child}, {"p": parent})
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and plan.count("Range (") == 2


# --- products by month

def sales(spark, *rows_):
    return spark.createDataFrame(rows_, "venta_id string, mes_carga string, valor long").withColumns({
        fv.SOURCE_YEAR: F.split("mes_carga", "-")[0], fv.SOURCE_MONTH: F.split("mes_carga", "-")[1]})


@pytest.fixture
def by_month(monkeypatch):
    def total(lake: Lake):
        facts = lake["fact_x"].groupBy("mes_carga").agg(F.sum("valor").alias("valor"))
        return facts.join(lake["dim_x"], "mes_carga", "left") if "dim_x" in lake else facts
    monkeypatch.setattr(gold.marts, "PRODUCTS", {"mart_ventas_mensual": total})


def test_only_touched_months_are_built_and_written(spark, folder, by_month):
    settings = Settings(folder, "comercial", "2026")
    only, domains = ["mart_ventas_mensual"], {"fact_x": "comercial"}
    table = LakeTable(spark, settings.table_path("silver", "fact_x"), PARTITIONS)
    product = gold.product_table(spark, settings, only[0])
    def refreshed():
        return rows(gold.refresh_changed(spark, settings, domains, only=only))
    def months():
        return {r.carpeta.rsplit("=", 1)[-1]: r.carpeta for r in product.folders().collect()}

    table.upsert(sales(spark, ("a", "2026-01", 1), ("b", "2026-02", 2), ("c", "2026-03", 4), ("d", None, 8)), ["venta_id"])
    assert refreshed() == [(only[0], 4)]
    before = months()
    assert refreshed() == [(only[0], 0)] and months() == before
    # b moves from February to April: both months change, the others keep their files
    table.upsert(sales(spark, ("b", "2026-04", 16)), ["venta_id"])
    assert refreshed() == [(only[0], 1)]
    after = months()
    assert {m for m in after if after[m] != before.get(m)} == {"2026-04"} and "2026-02" not in after
    assert rows(product.read(), "mes_carga", "valor") == sorted([("2026-01", 1), ("2026-03", 4), ("2026-04", 16), (None, 8)], key=repr)
    # rows without a month are a month of their own
    table.upsert(sales(spark, ("d", None, 32)), ["venta_id"])
    refreshed()
    assert {m for m in months() if months()[m] != after.get(m)} == {"__HIVE_DEFAULT_PARTITION__"}
    assert rows(product.read(), "mes_carga", "valor") == sorted([("2026-01", 1), ("2026-03", 4), ("2026-04", 16), (None, 32)], key=repr)


def test_a_changed_dimension_builds_all_months(spark, folder, by_month):
    settings = Settings(folder, "comercial", "2026")
    only, domains = ["mart_ventas_mensual"], {"fact_x": "comercial", "dim_x": "comercial"}
    LakeTable(spark, settings.table_path("silver", "fact_x"), PARTITIONS).upsert(sales(spark, ("a", "2026-01", 1), ("b", "2026-02", 2)), ["venta_id"])
    names = LakeTable(spark, settings.table_path("silver", "dim_x"))
    for wave in ("x", "y"):
        names.publish(spark.createDataFrame([("2026-01", wave)], "mes_carga string, nombre string"))
        assert rows(gold.refresh_changed(spark, settings, domains, only=only)) == [(only[0], 2)]
    assert rows(gold.product_table(spark, settings, only[0]).read(), "mes_carga", "nombre") == [("2026-01", "y"), ("2026-02", None)]


def test_replacing_everything_by_nothing_is_refused(spark, folder):
    table = LakeTable(spark, folder, ("m",))
    with pytest.raises(EmptyPublication):
        table.replace(spark.createDataFrame([], "x int, m string"), ["a"])
    table.replace(spark.createDataFrame([(1, "a"), (2, "b")], "x int, m string"), ["a", "b"])
    assert table.replace(spark.createDataFrame([], "x int, m string"), ["a"]) == 0
    assert rows(table.read()) == [(2, "b")]
    assert [rows(df) for df in table.changed_since(1)] == [[(1, "a")]]


# --- late lookups

def test_sales_that_come_after_their_returns_are_found(spark, folder):
    settings = Settings(folder, "comercial", "2026")
    def land(name, rows_, schema, day):
        LakeTable(spark, settings.table_path("bronze", name), PARTITIONS).append(bronze_rows(spark, rows_, schema, datetime(2026, 1, day)))
        return step_rows(silver.refresh(spark, settings, ["fact_devoluciones", "fact_ventas_cabecera"]).filter("table_name = 'fact_devoluciones'"))
    def days():
        return rows(LakeTable(spark, settings.table_path("silver", "fact_devoluciones"), PARTITIONS).read(), "devolucion_id", "dias_hasta_devolucion")

    land("fact_devoluciones", [(r, v, "2026-01-10", "Aprobada") for r, v in (("r1", "v1"), ("r2", "v2"), ("r3", "v9"))],
         "devolucion_id string, venta_id string, fecha_devolucion string, estado_devolucion string", 1)
    sold = ("100", "0", "19", "119", "60", "40", "1", None)
    schema = ("venta_id string, fecha_venta string, valor_bruto string, descuento_total string, iva_total string, valor_total string, "
              "costo_total string, margen_bruto string, numero_lineas string, campana_id string")
    passed = land("fact_ventas_cabecera", [("v1", "2026-01-01", *sold), ("v2", "2026-01-03", *sold)], schema, 2)
    assert days() == [("r1", 9), ("r2", 7), ("r3", None)]
    assert passed[fv.STEPS[0]] == ("NO_DATA", 0, 0) and passed[fv.STEPS[-1]] == ("SUCCESS", 2, 2)
    # a corrected sale is looked up again, one that did not change is not written again
    passed = land("fact_ventas_cabecera", [("v2", "2026-01-08", *sold)], schema, 3)
    assert days() == [("r1", 9), ("r2", 2), ("r3", None)] and passed[fv.STEPS[-1]] == ("SUCCESS", 1, 1)
