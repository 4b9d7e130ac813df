"""A small retail month from landed files to reconciled KPIs."""

import pytest
from pyspark.sql import functions as F
from conftest import rows

from tidemark import fixed_values as fv
from tidemark.contracts import contracts_from, dictionary_rows
from tidemark.operators.measures import derive
from tidemark.operators.quality import raise_on_errors
from tidemark.plans import bronze, gold, silver
from tidemark.plans.settings import Settings
from tidemark.sources import audit
from tidemark.sources.readers import read_dictionary
from tidemark.sources.tables import LakeTable

DICTIONARY = {
    "dim_ciudad": "*ciudad_id ciudad departamento region",
    "dim_tienda": "*tienda_id ciudad_id nombre_tienda tipo_sede estado_sede",
    "dim_canal_venta": "*canal_id canal tipo_canal descripcion",
    "dim_categoria_producto": "*categoria_id categoria familia especie_principal descripcion",
    "dim_producto": "*producto_id categoria_id sku nombre_producto marca especie unidad_medida nivel_rotacion precio_lista:float64 costo_estandar:float64",
    "dim_proveedor": "*proveedor_id ciudad_id proveedor tipo_proveedor especialidad estado_proveedor lead_time_promedio_dias:int64 calificacion_servicio:float64",
    "bridge_producto_proveedor": "*producto_id *proveedor_id costo_negociado:float64 lead_time_dias:int64",
    "dim_campana_marketing": "*campana_id campana tipo_campana categorias_objetivo canales_objetivo activa",
    "dim_transportista": "*transportista_id transportista tipo_transportista cobertura",
    "dim_motivo_devolucion": "*motivo_devolucion_id motivo_devolucion responsable_principal severidad",
    "fact_ventas_cabecera": "*venta_id mes_carga fecha_venta tienda_id ciudad_id canal_id campana_id estado_venta valor_bruto:float64 descuento_total:float64 iva_total:float64 valor_total:float64 costo_total:float64 margen_bruto:float64 numero_lineas:int64",
    "fact_ventas_detalle": "*detalle_venta_id mes_carga venta_id tienda_id ciudad_id canal_id categoria_id producto_id cantidad:int64 descuento_valor:float64 base_sin_iva:float64 iva_valor:float64 valor_total_linea:float64 costo_total_linea:float64 margen_bruto_linea:float64",
    "fact_devoluciones": "*devolucion_id mes_carga venta_id detalle_venta_id tienda_id ciudad_id categoria_id producto_id motivo_devolucion_id fecha_devolucion estado_devolucion cantidad_devuelta:int64 valor_reintegrado:float64 requiere_revision_calidad",
    "fact_marketing": "*marketing_id mes_carga campana_id ciudad_id canal_id medio_principal gasto_marketing:float64 impresiones:int64 clics:int64 leads:int64 conversiones_atribuidas:int64 ventas_atribuidas_valor:float64",
    "fact_inventario_mensual": "*mes_carga *tienda_id *producto_id categoria_id stock_inicial:int64 entradas_compras:int64 salidas_ventas:int64 ajuste_unidades:int64 merma_unidades:int64 stock_final:int64 punto_reorden:int64 stock_seguridad:int64 cobertura_dias:int64 valor_inventario_costo:float64",
    "fact_compras": "*orden_compra_id mes_carga tienda_id producto_id proveedor_id categoria_id motivo_compra estado_orden cantidad_comprada:int64 subtotal_sin_iva:float64 iva_valor:float64 valor_total_compra:float64",
    "fact_logistica_entregas": "*entrega_id mes_carga venta_id tienda_id ciudad_origen_id ciudad_destino_id canal_id transportista_id empleado_repartidor_id estado_entrega fecha_entrega dias_prometidos:int64 dias_reales_entrega:int64 dias_retraso:int64 peso_estimado_kg:float64 costo_envio:float64",
    "fact_costos_mensual": "*costo_id mes_carga tienda_id monto_presupuestado:float64 monto_real:float64",
    "fact_presupuesto_mensual": "*presupuesto_id mes_carga tienda_id monto_presupuesto:float64 monto_ejecutado:float64",
    "fact_objetivos_mensuales": "*objetivo_id mes_carga tienda_id meta_ventas:float64 meta_tickets:int64 meta_margen_bruto:float64 meta_tasa_devolucion:float64 meta_entregas:int64",
    "resumen_mensual_validacion": "*mes_carga ventas:int64 valor_total:float64 margen_bruto:float64 devoluciones:int64 valor_reintegrado:float64",
}
FULL = {
    "dim_ciudad": ["C1,Bogotá,Cundinamarca,Andina", "C2,Cali,Valle,Pacífica"],
    "dim_tienda": ["T1,C1,Centro, Principal ,Activa", "T2,C2,Sur,,Activa"],
    "dim_canal_venta": ["K1,Tienda,Fisico,x", "K2,Web,Digital,y"],
    "dim_categoria_producto": ["G1,Alimento,Seco,Perro,d"],
    "dim_producto": ["P1,G1,0001,Croquetas,M,Perro,kg,Alta,100.00,60.00"],
    "dim_proveedor": ["S1,C1,Prov,Local,Alimento,Activo,7,4.5"],
    "bridge_producto_proveedor": ["P1,S1,50.00,"],
    "dim_campana_marketing": ["M1,Enero,Digital,todas,todos,si"],
    "dim_transportista": ["R1,Rapido,Terrestre,Nacional"],
    "dim_motivo_devolucion": ["D1,Defecto,Tienda,Alta"],
}
JANUARY = {
    "fact_ventas_cabecera": ["V1,2026-01,2026-01-03,T1,C1,K1,M1,Emitida,200,20,34.20,214.20,120,60,2",
                             "V2,2026-01-01,2026-01-04,T1,C1,K1,,emitida,100,0,19,119,60,40,1"],
    "fact_ventas_detalle": ["L1,2026-01,V1,T1,C1,K1,G1,P1,2,20,180,34.20,214.20,120,60", "L2,2026-01,V2,T1,C1,K1,G1,P1,1,0,100,19,119,60,40"],
    "fact_devoluciones": ["X1,2026-01,V1,L1,T1,C1,G1,P1,D1,2026-01-10,Aprobada,1,107.10,si"],
    "fact_marketing": ["Q1,2026-01,M1,C1,K1,Redes,50,1000,100,10,0,400"],
    "fact_inventario_mensual": ["2026-01,T1,P1,G1,10,5,3,0,0,12,12,5,30,720"],
    "fact_compras": ["O1,2026-01,T1,P1,S1,G1,Reposicion,Recibida,5,250,47.50,297.50"],
    "fact_logistica_entregas": ["E1,2026-01,V1,T1,C1,C2,K1,R1,,Entregado,2026-01-05,3,2,-1,4,12"],
    "fact_costos_mensual": ["A1,2026-01,T1,80,90"],
    "fact_presupuesto_mensual": ["B1,2026-01,T1,100,95"],
    "fact_objetivos_mensuales": ["J1,2026-01,T1,300,2,90,0.1,1"],
    "resumen_mensual_validacion": ["2026-01,2,333.20,100,1,107.10"],
}


def header(table):
    return [c.lstrip("*").split(":")[0] for c in DICTIONARY[table].split()]


def write(folder, month, table, lines, columns=None):
    folder = folder / month if month else folder
    folder.mkdir(parents=True, exist_ok=True)
    name = f"{table}_{month}.csv" if month else f"{table}.csv"
    (folder / name).write_text("\n".join([",".join(columns or header(table)), *lines]) + "\n", encoding="utf-8")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lines = ["tabla,campo,tipo_dato_csv,rol"]
    for t, columns in DICTIONARY.items():
        for c in columns.split():
            name, _, kind = c.lstrip("*").partition(":")
            lines.append(f"{t},{name},{kind or 'object'},{'PK' if c.startswith('*') else ''}")
    (root / "dictionary.csv").write_text("\n".join(lines) + "\n")
    contracts = contracts_from(dictionary_rows(read_dictionary(spark, str(root / "dictionary.csv"))))
    settings = Settings(str(root), "comercial", "2026")
    landing = root / "raw" / "comercial" / "2026"
    for t, data in FULL.items():
        write(landing, None, t, data)
    for t, data in JANUARY.items():
        write(landing, "01", t, data)
    return root, landing, settings, contracts


def test_settings_know_the_domains():
    with pytest.raises(ValueError):
        Settings("/x", "otro", "2026")


def test_month_end_to_end(spark, lake):
    root, landing, settings, contracts = lake
    (landing / "notas.xlsx").write_text("?")
    write(landing, "01", "fact_nueva", ["1"], ["x"])
    write(landing, "02", "fact_costos_mensual", ["A2,2026-03,T1,1,2"])
    write(landing, "02", "fact_presupuesto_mensual", ["B2,T1"], ["presupuesto_id", "tienda_id"])

    # bronze: good batches load although others fail
    entries = bronze.load(spark, settings, contracts)
    failed = {r.source_file_name: r.error_message for r in entries.filter("status = 'FAILED'").collect()}
    assert set(failed) == {"notas.xlsx", "fact_nueva_01.csv", "fact_costos_mensual_02.csv", "fact_presupuesto_mensual_02.csv"}
    assert "2026-03" in failed["fact_costos_mensual_02.csv"] and "missing" in failed["fact_presupuesto_mensual_02.csv"]
    assert entries.filter("status = 'SUCCESS'").count() == len(FULL) + len(JANUARY)
    with pytest.raises(bronze.Rejected):
        bronze.raise_on_failures(entries)
    stored = LakeTable(spark, settings.table_path("bronze", "fact_ventas_cabecera"), bronze.PARTITIONS).read()
    assert rows(stored, fv.SOURCE_YEAR, fv.SOURCE_MONTH, fv.LOAD_MODE, "venta_id")[0] == ("2026", "01", "incremental", "V1")
    plan = bronze.archive_plan(spark, settings)
    assert plan.count() == len(FULL) + len(JANUARY)
    assert plan.filter("archive_status = 'SUCCESS' and por_mover").count() == plan.count()

    moved = plan.filter("table_name <> 'dim_ciudad'")
    assert bronze.record_archive(spark, settings, moved) == len(FULL) + len(JANUARY) - 1
    assert rows(bronze.archive_plan(spark, settings), "table_name") == [("dim_ciudad",)]
    log = audit.read(spark, settings.log_path("bronze"), audit.LOAD_LOG)
    assert log.filter("archive_status = 'SUCCESS' and archived_at is not null").count() == len(FULL) + len(JANUARY) - 1
    assert log.count() == entries.count()

    # silver: one pass of the four steps, then nothing new
    tables = [*FULL, *JANUARY]
    summary = silver.refresh(spark, settings, tables)
    assert rows(summary.filter("status <> 'SUCCESS'")) == [] and summary.count() == len(tables) * len(fv.STEPS)
    again = silver.refresh(spark, settings, ["fact_compras"])
    assert rows(again, "status", "output_rows") == [("NO_DATA", 0)] * len(fv.STEPS)
    lake_tables = gold.silver_lake(spark, settings, {t: "comercial" for t in tables})
    sales = rows(lake_tables["fact_ventas_cabecera"], "venta_id", "mes_carga", "tiene_campana", "campana_null_reason",
                 "estado_venta_codigo", "estado_venta_codigo_valido", fv.SILVER_STEP)
    assert sales == [("V1", "2026-01", True, None, "emitida", True, fv.STEPS[-1]),
                     ("V2", "2026-01", False, "venta_sin_campana", "emitida", False, fv.STEPS[-1])]
    assert rows(lake_tables["fact_devoluciones"], "dias_hasta_devolucion") == [(7,)]
    assert rows(lake_tables["dim_producto"], "sku") == [("0001",)]

    # quality
    report = silver.check(spark, settings, {t: lake_tables[t] for t in tables})
    assert rows(report.filter("status = 'FAIL'")) == []
    assert report.filter("status = 'SKIPPED'").count() > 0
    raise_on_errors(report)

    # gold
    published = {r.table_name: r.rows for r in gold.refresh(spark, settings, lake_tables).collect()}
    assert set(published) == set(gold.PRODUCT_DOMAIN) and all(n > 0 for n in published.values())
    mart = gold.product_table(spark, settings, "mart_ventas_mensual").read().first()
    assert (float(mart.ventas_totales), mart.numero_ventas, mart.ventas_con_campana, mart.tienda_region) == (333.2, 2, 1, "Andina")
    assert mart.participacion_campana_pct == 0.5 and mart.canal_nombre == "Tienda"
    bought = gold.product_table(spark, settings, "mart_compras_proveedores_mensual").read().first()
    assert (bought.costo_negociado_promedio, bought.lead_time_promedio_proveedor, bought.variacion_vs_costo_negociado) == (50.0, 7.0, 0.0)
    goals = gold.product_table(spark, settings, "mart_objetivos_mensual").read().first()
    assert (goals.cumple_meta_ventas, goals.cumple_meta_tickets, goals.cumple_meta_margen) == (True, True, True)
    kpi = gold.product_table(spark, settings, "mart_kpis_ejecutivos_mensual").read().first()
    assert (kpi.mes_carga, float(kpi.ventas_netas), kpi.tasa_devolucion, kpi.entregas_a_tiempo_pct, kpi.marketing_roas) == \
        ("2026-01", 226.1, 0.5, 1.0, 8.0)
    assert rows(gold.product_table(spark, settings, "gold_quality_checks").read(), "mes_carga", "gold_quality_status") == [("2026-01", "PASS")]


def test_a_late_correction_reaches_silver_through_the_mark(spark, lake):
    root, landing, settings, contracts = lake
    other = Settings(str(root), "finanzas", "2026")
    first = root / "raw" / "finanzas" / "2026"
    write(first, "01", "fact_costos_mensual", JANUARY["fact_costos_mensual"])
    write(first, "02", "fact_costos_mensual", ["A9,2026-02,T1,5,6"])
    bronze.raise_on_failures(bronze.load(spark, other, contracts))
    silver.refresh(spark, other, ["fact_costos_mensual"])
    # the February file again, now with a correction of January's row as well, in January's folder
    (first / "01" / "fact_costos_mensual_01.csv").write_text(",".join(header("fact_costos_mensual")) + "\nA1,2026-01,T1,80,99\n")
    bronze.load(spark, other, contracts)
    silver.refresh(spark, other, ["fact_costos_mensual"])
    out = gold.silver_lake(spark, other, {"fact_costos_mensual": "finanzas"})["fact_costos_mensual"]
    assert [(r[0], float(r[1])) for r in rows(out, "costo_id", "variacion_costo")] == [("A1", 19.0), ("A9", 1.0)]
    marks = audit.read(spark, other.log_path("silver"), audit.STEP_LOG)
    marks = marks.filter(F.col("step_name") == fv.STEPS[0])
    assert marks.filter("status = 'SUCCESS'").count() == 2
    assert marks.orderBy("updated_at").collect()[1].previous_watermark is not None


def test_rows_left_between_steps_are_resumed(spark, folder):
    settings = Settings(folder, "operaciones", "2026")
    raw = spark.createDataFrame([("A1", "2026-01", "T1", "2.00", "3.00", "2026", "01")],
                                "costo_id string, mes_carga string, tienda_id string, monto_presupuestado string, "
                                "monto_real string, _tm_source_year string, _tm_source_month string")
    half = silver.run_step("schema_standardization", "fact_costos_mensual", raw, domain="operaciones")
    t = LakeTable(spark, settings.table_path("silver", "fact_costos_mensual"), bronze.PARTITIONS)
    t.upsert(half, ["costo_id"])
    assert silver.resume_table(spark, settings, "fact_costos_mensual") == 1
    done = t.read()
    assert rows(done, fv.SILVER_STEP) == [(fv.STEPS[-1],)]
    assert rows(done, "variacion_costo") == rows(derive("fact_costos_mensual", done), "variacion_costo")
    assert silver.resume_table(spark, settings, "fact_costos_mensual") == 0


def test_nothing_landed_is_logged(spark, folder):
    found = bronze.load(spark, Settings(folder, "shared", "2026"), {})
    assert rows(found, "status", "table_name") == [("NO_DATA", fv.NO_FILES)]
    assert rows(silver.refresh(spark, Settings(folder, "shared", "2026"), []), "status") == [("NO_DATA",)]


def test_silver_keeps_rows_of_a_table_only_the_dictionary_knows(spark, folder):
    from pathlib import Path

    from tidemark.contracts import TableContract
    settings = Settings(folder, "comercial", "2026")
    landing = Path(folder) / "raw" / "comercial" / "2026"
    write(landing, None, "fact_nueva", ["a,1", "b,2", "c,3"], ["id", "n"])
    write(landing, None, "fact_sin_clave", ["1", "1", "2"], ["n"])
    contracts = {"fact_nueva": TableContract("fact_nueva", (("id", "string"), ("n", "bigint")), ("id",)),
                 "fact_sin_clave": TableContract("fact_sin_clave", (("n", "bigint"),))}
    bronze.raise_on_failures(bronze.load(spark, settings, contracts))
    silver.refresh(spark, settings, contracts)
    lake = gold.silver_lake(spark, settings, {t: "comercial" for t in contracts})
    assert rows(lake["fact_nueva"], "id") == [("a",), ("b",), ("c",)]
    assert rows(lake["fact_sin_clave"], "n") == [(1,), (2,)]


def test_one_bad_table_does_not_lose_the_log(spark, folder, monkeypatch):
    from pathlib import Path

    from tidemark.contracts import TableContract
    settings = Settings(folder, "comercial", "2026")
    landing = Path(folder) / "raw" / "comercial" / "2026"
    contracts = {t: TableContract(t, (("id", "string"),), ("id",)) for t in ("a", "b", "c")}
    for t in contracts:
        write(landing, None, t, ["1"], ["id"])
    bronze.raise_on_failures(bronze.load(spark, settings, contracts))
    run = silver.run_steps

    def broken(table, *args, **named):
        if table == "b":
            raise RuntimeError("roto")
        return run(table, *args, **named)
    monkeypatch.setattr(silver, "run_steps", broken)
    silver.refresh(spark, settings, contracts)
    log = audit.read(spark, settings.log_path("silver"), audit.STEP_LOG).filter(F.col("step_name") == fv.STEPS[0])
    assert rows(log, "table_name", "status", "message") == [("a", "SUCCESS", None), ("b", "FAILED", "roto"), ("c", "SUCCESS", None)]


def test_files_are_counted_and_refused_one_by_one(spark, folder):
    from pathlib import Path

    from tidemark.contracts import TableContract
    settings = Settings(folder, "comercial", "2026")
    landing = Path(folder) / "raw" / "comercial" / "2026"
    contract = {"t": TableContract("t", (("id", "string"), ("n", "bigint")), ("id",))}
    (landing / "01").mkdir(parents=True)
    for name, text in {"t.csv": "id,n\na,1\nb,2.5\n", "t_01.csv": "n,id\n3,c\n4,d\n5,e\n", "t.json": '{"id": "f"}\n', "t.parquet": "no"}.items():
        (landing / "01" / name).write_text(text)
    entries = bronze.load(spark, settings, contract)
    got = {r.source_file_name: (r.status, r.record_count) for r in entries.collect()}
    assert got == {"t.csv": ("SUCCESS", 2), "t_01.csv": ("SUCCESS", 3), "t.json": ("FAILED", None), "t.parquet": ("FAILED", None)}
    assert "n" in entries.filter("source_file_name = 't.csv'").first().error_message
    stored = LakeTable(spark, settings.table_path("bronze", "t"), bronze.PARTITIONS).read()
    assert rows(stored, "id", "n") == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]


def test_log_clock_does_not_depend_on_the_zone(spark):
    import time
    from datetime import datetime, timezone
    entry = audit.entries(spark, audit.STEP_LOG, [{"step_name": "s"}])
    seconds = entry.select(F.unix_timestamp("created_at")).first()[0]
    assert abs(seconds - time.time()) < 60 and datetime.now(timezone.utc)
