"""What is shuffled, and how often, by plans over large tables."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from suite.tables import base_lake, silver_lake
from tidemark.operators.rollup import Lake
from tidemark.plans import dims, marts

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcasts(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lines_meet_their_orders_where_they_were_deduplicated(spark, no_broadcasts):
    plan = base_lake(spark, SF)["fact_compras"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert plan.count("SortMergeJoin [l_orderkey") == 1


def exchanges(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]


def test_products_that_meet_their_movements_are_not_shuffled_again(spark, no_broadcasts):
    lake = silver_lake(spark, SF)
    assert len(exchanges(marts.inventory_core(lake))) == len(exchanges(base_lake(spark, SF)["fact_inventario_mensual"]))
    last = exchanges(base_lake(spark, SF)["fact_inventario_mensual"])
    assert sum("hashpartitioning(producto_id" in x for x in last) == 1 and not any("hashpartitioning(l_partkey" in x for x in last)


def test_lines_are_staged_without_what_can_be_derived(spark):
    stored = base_lake(spark, SF, staged="lines")["fact_ventas_detalle"].inputFiles()
    kept = spark.read.parquet(*stored)
    assert not {"detalle_venta_id", "venta_id", "producto_id", "mes_carga", "valor_total_linea", "margen_bruto_linea"} & set(kept.columns)


def test_rows_of_staged_lines_go_to_their_order_before_they_are_summed(spark, no_broadcasts):
    plan = base_lake(spark, SF, staged="lines")["fact_ventas_cabecera"]._jdf.queryExecution().executedPlan().toString()
    (dealt,) = [x for x in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert "REPARTITION_BY_COL" in dealt


def test_suppliers_meet_lines_before_anything_is_derived(spark, no_broadcasts):
    plan = base_lake(spark, SF, staged="lines")["fact_logistica_entregas"]._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join Inner, (l_suppkey"):]
    assert "date_format" not in join and "decimal" not in join.split("Relation")[0]


def test_a_part_that_is_there_twice_counts_twice_in_stock(spark, folder, no_broadcasts):
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    part = spark.read.parquet(f"{SF}/part.parquet")
    twice = part.filter("p_partkey % 3 = 0")
    other = part.filter("p_partkey % 5 = 0").withColumn("p_size", F.col("p_size") + 1)
    part.unionByName(twice).unionByName(other).write.parquet(f"{folder}/part.parquet")
    plain, staged = (base_lake(spark, folder, staged=s)["fact_inventario_mensual"] for s in ("", "lines"))
    assert plain.columns == staged.columns and rows(plain) == rows(staged)


# --- products with nearly as many groups as lines

def test_sold_products_are_grouped_and_named_where_they_lie(spark, no_broadcasts):
    sold = exchanges(marts.product_sales(silver_lake(spark, SF)))
    assert not any("hashpartitioning(mes_carga" in x for x in sold)
    assert sum("hashpartitioning(producto_id" in x and "REPARTITION_BY_COL" in x for x in sold) == 2


def lake_of(spark, name, data, schema):
    return Lake({name: spark.createDataFrame(data, schema)}, keyed=[name])


def test_sales_of_products_add_up_over_shares(spark):
    places = [("2026-01", "t", "c", "k", "g", p) for p in ("p", "q", None)] + [(None, None, "c", "k", None, "p")]
    data = [(f"d{i}-{j}" if i % 5 else None, None if i % 7 == 0 else f"v{i % 40}", *place, i, *[Decimal(i * j) / 100] * 4)
            for i in range(120) for j, place in enumerate(places) if (i + j) % 3]
    lake = lake_of(spark, "fact_ventas_detalle", data, "detalle_venta_id string, venta_id string, mes_carga string, tienda_id string, ciudad_id string, "
                   "canal_id string, categoria_id string, producto_id string, cantidad bigint, base_sin_iva decimal(18,2), valor_total_linea decimal(18,2), "
                   "costo_total_linea decimal(18,2), margen_bruto_linea decimal(18,2)")
    plain, dealt = marts.product_sales_core(lake), marts._sold_by_product(lake)
    assert dealt.dtypes == plain.dtypes and rows(dealt) == rows(plain) and len(rows(plain)) == 4


def test_products_keep_their_columns_in_order(spark):
    lake = silver_lake(spark, SF)
    joined = dims.attach(dims.attach_store(marts.product_sales_core(lake), lake), dims.city(lake), dims.channel(lake), dims.product(lake), dims.category(lake))
    assert marts.product_sales(lake).dtypes == joined.dtypes


def test_purchases_are_grouped_where_they_meet_their_terms(spark, no_broadcasts):
    bought = exchanges(marts.purchases(silver_lake(spark, SF, staged="lines")))
    assert not any("hashpartitioning(mes_carga" in x for x in bought)
    (dealt,) = [x for x in bought if "hashpartitioning(producto_id" in x and "proveedor_id" in x and "REPARTITION_BY_COL" in x]
    first = next(x for x in bought if "hashpartitioning(tienda_id" in x)  # stores come after products and suppliers
    assert bought.index(first) < bought.index(dealt)


def test_returned_sales_and_lines_are_counted_without_expanding_rows(spark, no_broadcasts):
    plan = marts.returns(silver_lake(spark, SF, staged="lines sales"))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_returned_sales_and_lines_are_counted_as_together(spark):
    data = [(f"r{i}", f"v{i % 9}" if i % 4 else None, f"d{i % 11}" if i % 3 else None, "2026-01" if i % 2 else None, "t", "c", "g" if i % 5 else None, "p",
             "m", i, Decimal(i) / 10, i % 6 == 0, i if i % 7 else None) for i in range(200)]
    lake = lake_of(spark, "fact_devoluciones", data, "devolucion_id string, venta_id string, detalle_venta_id string, mes_carga string, tienda_id string, "
                   "ciudad_id string, categoria_id string, producto_id string, motivo_devolucion_id string, cantidad_devuelta bigint, "
                   "valor_reintegrado decimal(18,2), requiere_revision_calidad boolean, dias_hasta_devolucion int")
    together, apart = marts.returns_measures(lake), marts._returned_apart(lake)
    assert sorted(apart.dtypes) == sorted(together.dtypes) and rows(apart.select(*together.columns)) == rows(together) and len(rows(together)) == 4
