import pytest
from conftest import rows

from tidemark.operators import quality


def test_checks_count_values_not_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "k int, v string")
    assert quality.unique_key("t", df, ["k"]).first().failing_count == 1
    found = {r.check_name: r.failing_count for r in quality.row_checks("t", df, ["k"]).collect()}
    assert found == {"primary_key_not_null": 1, "table_not_empty": 0}
    assert quality.row_checks("t", df.filter("k > 9"), ["k"]).filter("check_name = 'table_not_empty'").first().failing_count == 1


def test_orphans_are_distinct_and_ignore_nulls(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (8,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    assert rows(quality.orphans(child, "fk", parent, "pk")) == [(8,), (9,)]


def test_identities_pass_when_an_operand_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.019), (1.0, 1.03), (1.0, None)], "a double, b double")
    checks = quality.row_checks("t", df, (), [("a = b", "a - b", 0.02)])
    assert checks.filter("check_name = 'arithmetic_consistency'").first().failing_count == 1


def test_one_pass_serves_all_row_checks_of_a_table(spark):
    df = spark.range(10).selectExpr("id as k", "id as a", "id as b")
    checks = quality.row_checks("t", df, ["k"], [("one", "a - b", 0), ("two", "b - a", 0)])
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    assert checks.count() == 4 and plan.count("Range (") == 1


def test_report_says_what_it_skipped(spark):
    tables = {"dim_tienda": spark.createDataFrame([("t", "c")], "tienda_id string, ciudad_id string")}
    report = quality.report(tables, spark)
    assert rows(report.filter("status = 'SKIPPED'"), "check_name") == [("fk_ciudad_id_to_dim_ciudad_ciudad_id",)]
    assert quality.report(tables, spark, note_skipped=False).filter("status <> 'PASS'").isEmpty()
    assert rows(quality.report({}, spark), "check_name", "severity", "status") == [("no_silver_tables", "INFO", "PASS")]


def test_gate_stops_on_failed_errors(spark):
    twice = {"dim_ciudad": spark.createDataFrame([("c",), ("c",)], "ciudad_id string")}
    with pytest.raises(ValueError, match="dim_ciudad.primary_key_unique"):
        quality.raise_on_errors(quality.report(twice, spark))


def test_key_checks_equal_the_separate_ones(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (None, None), (3, "c")], "k int, v string")
    for keys in (["k"], ["k", "v"]):
        found = {r.check_name: r.failing_count for r in quality.key_checks("t", df, keys).collect()}
        assert found["primary_key_unique"] == quality.unique_key("t", df, keys).first().failing_count == 2
        assert found == {r.check_name: r.failing_count for r in quality.row_checks("t", df, keys).collect()} | {"primary_key_unique": 2}
    assert quality.key_checks("t", df.filter("k > 9"), ["k"]).filter("failing_count > 0").first().check_name == "table_not_empty"


def test_parents_come_from_the_own_domain_else_from_shared(spark):
    child = {"dim_tienda": spark.createDataFrame([("t", "c")], "tienda_id string, ciudad_id string")}
    city = lambda c: {"dim_ciudad": spark.createDataFrame([(c,)], "ciudad_id string")}
    for own, shared, status in (({}, city("c"), "PASS"), ({}, city("x"), "FAIL"), (city("c"), city("x"), "PASS"), ({}, {}, "SKIPPED")):
        report = quality.report({**child, **own}, spark, shared=shared)
        assert rows(report.filter("check_name = 'fk_ciudad_id_to_dim_ciudad_ciudad_id'"), "status") == [(status,)]
        assert own or report.filter("table_name = 'dim_ciudad'").isEmpty()


def test_keys_that_references_look_for_are_checked_by_the_grouping_of_references(spark):
    city = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), (None,), (None,), ("c",)], "ciudad_id string")
    store = spark.createDataFrame([("t", "a"), ("u", "x"), ("v", "x"), ("w", None), ("x", "y")], "tienda_id string, ciudad_id string")
    for cities in (city, city.filter("ciudad_id = 'c'"), city.filter("ciudad_id > 'c'"), city.filter("ciudad_id is null")):
        tables = {"dim_ciudad": cities, "dim_tienda": store}
        report = quality.report(tables, spark, note_skipped=False)
        alone = {(r.check_name, r.failing_count, r.description) for r in quality.key_checks("dim_ciudad", cities, ["ciudad_id"]).collect()}
        own = report.filter("table_name = 'dim_ciudad'")
        assert {(r.check_name, r.failing_count, r.description) for r in own.collect()} == alone and own.count() == 3
        orphans = quality.orphans(store, "ciudad_id", cities, "ciudad_id").count()
        assert rows(report.filter("check_name like 'fk%'"), "failing_count") == [(orphans,)]
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [ciudad_id" not in plan
    reals = {"dim_ciudad": spark.createDataFrame([(0.0,), (-0.0,)], "ciudad_id double"), "dim_tienda": store}
    found = quality.report(reals, spark).filter("table_name = 'dim_ciudad' and check_name = 'primary_key_unique'")
    assert rows(found, "failing_count") == [(1,)]  # zeros that differ in their texts alone
