"""A third of all rows on one key: results are whole, and the hot key is split or combined early."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.measures import days_to_return
from tidemark.operators.rollup import monthly, total

HOT = "V0"


def hot_ids(spark, n):
    """n rows, every third of them on the same sale."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("devolucion_id"),
        F.when(F.col("id") % 3 == 0, HOT).otherwise(F.concat(F.lit("V"), F.col("id").cast("string"))).alias("venta_id"),
        F.lit(date(2026, 1, 10)).alias("fecha_devolucion"), F.lit("2026-01").alias("mes_carga"),
        F.lit(1).alias("cantidad_devuelta"))


@pytest.fixture
def shuffled_joins(spark):
    """Small thresholds, so that adaptive execution acts at test size as it would on large partitions."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_returns_of_one_sale_are_split_over_tasks(spark, shuffled_joins):
    n = 300_000
    sales = spark.range(n).select(
        F.when(F.col("id") == 0, HOT).otherwise(F.concat(F.lit("V"), F.col("id").cast("string"))).alias("venta_id"),
        F.lit(date(2026, 1, 10) - timedelta(days=4)).alias("fecha_venta"))
    # wide rows in several map tasks, as a real table has
    back = hot_ids(spark, n).withColumn("relleno", F.sha2("devolucion_id", 512))
    out = days_to_return(back, sales)
    counted = out.groupBy("dias_hasta_devolucion").agg(F.count("*").alias("n"), F.max("relleno"))
    assert [(r[0], r[1]) for r in counted.collect()] == [(4, n)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_hot_groups_are_combined_before_the_shuffle(spark):
    n = 120_000
    out = monthly(hot_ids(spark, n), "venta_id", unidades=total("cantidad_devuelta"), filas=F.count("*"))
    assert out.filter(F.col("venta_id") == HOT).first().filas == n // 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_distinct_counts_of_a_hot_group_are_exact(spark):
    n = 90_000
    one_month = monthly(hot_ids(spark, n), ventas=F.count_distinct("venta_id"), devoluciones=F.count_distinct("devolucion_id"))
    assert tuple(one_month.first()) == ("2026-01", n - n // 3 + 1, n)


def test_orphans_shrink_before_the_join(spark):
    n = 90_000
    child = hot_ids(spark, n)
    parent = child.filter(F.col("venta_id") != HOT).select("venta_id")
    assert [r[0] for r in quality.orphans(child, "venta_id", parent, "venta_id").collect()] == [HOT]
