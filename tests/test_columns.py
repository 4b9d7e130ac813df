from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.contracts import TableContract, contracts_from, dictionary_rows, is_known, merge_keys
from tidemark.functions import columns as c
from tidemark.operators import standardize as std
from tidemark.operators.measures import derive


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(spark, values, expression, kind="string"):
    df = one_column(spark, values, kind)
    return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("text, expected", [
    ("2026-01", True), ("2026-01-01", True), ("2026-01 00:00:00", True), (" 2026-01 ", True),
    ("2026-02", False), ("202601", False), ("2026-0101", False)])
def test_a_month_text_is_accepted_only_when_the_month_ends_it(spark, text, expected):
    assert evaluate(spark, [text], c.in_month("v", "2026-01")) == [expected]


def test_month_key_takes_the_leading_month_or_nothing(spark):
    texts = ["2026-01", " 2026-01-31 ", "2026-01 00:00:00", "202601", "01/2026", "", None]
    assert evaluate(spark, texts, c.month_key("v")) == ["2026-01"] * 3 + [None] * 4


def test_rows_without_a_month_use_their_folder_and_full_loads_stay_null(spark):
    df = spark.createDataFrame(
        [("2026-03", "2026", "01"), (None, "2026", "01"), (None, "2026", None)],
        "mes_carga string, _tm_source_year string, _tm_source_month string")
    assert [r[0] for r in df.select(c.month_of_row(df.columns)).collect()] == ["2026-03", "2026-01", None]


def test_flags(spark):
    words = ["true", " T ", "1", "YES", "y", "si", "S", "sí", "False", "f", "0", "no", "N", "maybe", "", None]
    assert evaluate(spark, words, c.flag("v")) == [True] * 8 + [False] * 5 + [None] * 3


def test_numbers_keep_bad_cells_as_null_and_accept_decimals_of_whole_numbers(spark):
    assert evaluate(spark, ["12", " 7 ", "12.0", "007", "x", "", None], c.whole_number("v")) == [12, 7, 12, 7, None, None, None]


def test_ratio_is_null_for_null_or_zero_denominators(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("4.00")), (Decimal("1.00"), Decimal("0.00")),
                                (Decimal("1.00"), None), (None, Decimal("2.00"))], "a decimal(18,2), b decimal(18,2)")
    assert [r[0] for r in df.select(c.ratio("a", "b")).collect()] == [0.25, None, None, None]


def test_codes(spark):
    labels = [" En revisión ", "Cancelado en ruta", "--A/B--", "", None]
    assert evaluate(spark, labels, c.domain_code("v")) == ["en_revisi_n", "cancelado_en_ruta", "a_b", "", None]


def test_hash_tells_apart_what_a_separator_would_join(spark):
    df = spark.createDataFrame([("a", "b||c"), ("a||b", "c"), ("a", None), ("a", "<null>"), ("a", "null")], "x string, y string")
    assert df.select(c.record_hash(["x", "y"]).alias("h")).distinct().count() == 5


def test_types_follow_names(spark):
    df = spark.createDataFrame(
        [("2026-01-05", "si", "10.555", "0.12345", "3.0", "1.5", "007", "0042", "2026-01-09", "x ")],
        "fecha_venta string, activa string, valor_total string, iva_tasa string, cantidad string, latitud string, "
        "venta_id string, sku string, mes_carga string, otra string")
    out = std.standardize(df)
    kinds = dict(out.dtypes)
    assert kinds == {"fecha_venta": "date", "activa": "boolean", "valor_total": "decimal(18,2)", "iva_tasa": "decimal(10,4)",
                     "cantidad": "bigint", "latitud": "double", "venta_id": "string", "sku": "string", "mes_carga": "string",
                     "otra": "string"}
    assert tuple(out.first()) == (date(2026, 1, 5), True, Decimal("10.56"), Decimal("0.1235"), 3, 1.5, "007", "0042", "2026-01", "x")


def test_a_date_key_is_a_number_although_it_ends_in_id(spark):
    df = spark.createDataFrame([("20260105",)], "fecha_id string")
    assert std.type_by_name(df).dtypes == [("fecha_id", "bigint")]


def test_bad_cells_become_null(spark):
    df = spark.createDataFrame([("ayer", "doce", "1,5", "muchos")], "fecha string, valor_total string, iva_tasa string, cantidad string")
    assert tuple(std.standardize(df).first()) == (None, None, None, None)


def test_null_policies(spark):
    days = spark.createDataFrame([(1, True, "Navidad"), (2, False, "Navidad"), (3, None, "Navidad")],
                                 "fecha_id long, es_festivo_colombia boolean, festivo_nombre string")
    assert [r.festivo_nombre for r in std.explain_nulls("dim_fecha", days).orderBy("fecha_id").collect()] == ["Navidad", None, None]
    staff = spark.createDataFrame([("e1", "t1"), ("e2", "  ")], "empleado_id string, tienda_id string")
    assert rows(std.explain_nulls("dim_empleado", staff)) == [("e1", "t1", False, "t1"), ("e2", None, True, "NO_APLICA")]
    sent = spark.createDataFrame(
        [("a", "r", "t", "Entregado", date(2026, 1, 1)), ("b", None, "t", "Cancelado en ruta", None), ("c", None, None, None, None)],
        "entrega_id string, empleado_repartidor_id string, transportista_id string, estado_entrega string, fecha_entrega date")
    found = rows(std.explain_nulls("fact_logistica_entregas", sent),
                 "entrega_id", "empleado_repartidor_null_reason", "fecha_entrega_null_reason")
    assert found == [("a", None, None), ("b", "transportista_tercero", "cancelado_en_ruta"),
                     ("c", "sin_repartidor_informado", "pendiente_o_no_entregado")]


def test_codes_and_validity_look_at_the_raw_value(spark):
    df = spark.createDataFrame([("Emitida", "Perro Grande"), ("emitida", None), (None, "x")],
                               "estado_venta string, tipo_mascota_principal string")
    out = std.add_domain_codes(df)
    assert out.columns == ["estado_venta", "tipo_mascota_principal", "estado_venta_codigo", "estado_venta_codigo_valido",
                           "tipo_mascota_codigo"]
    assert rows(out, "estado_venta_codigo", "estado_venta_codigo_valido", "tipo_mascota_codigo") == \
        [("emitida", False, None), ("emitida", True, "perro_grande"), (None, True, "x")]


def test_delivery_flags_stay_unknown_when_the_delay_is(spark):
    df = spark.createDataFrame(
        [("a", "Entregado", date(2026, 1, 2), 0, None), ("b", "Entregado", date(2026, 1, 2), None, "e"),
         ("c", "Entregado tarde", None, None, None), ("d", None, date(2026, 1, 2), 3, None)],
        "entrega_id string, estado_entrega string, fecha_entrega date, dias_retraso long, empleado_repartidor_id string") \
        .withColumns({"costo_envio": F.lit(Decimal("10.00")), "peso_estimado_kg": F.lit(4.0)})
    out = rows(derive("fact_logistica_entregas", df), "entrega_id", "entrega_a_tiempo", "entrega_tardia", "entrega_pendiente",
               "tipo_entrega_operativa", "costo_por_kg")
    assert out == [("a", True, False, False, "Tercero", 2.5), ("b", None, None, False, "Interna", 2.5),
                   ("c", False, True, True, "Tercero", 2.5), ("d", False, True, False, "Tercero", 2.5)]


def test_returns_of_unknown_sales_stay(spark):
    back = spark.createDataFrame([("d1", "v1", date(2026, 1, 9), "En revision"), ("d2", "v9", date(2026, 1, 9), None)],
                                 "devolucion_id string, venta_id string, fecha_devolucion date, estado_devolucion string")
    sales = spark.createDataFrame([("v1", date(2026, 1, 4))], "venta_id string, fecha_venta date")
    out = rows(derive("fact_devoluciones", back, sales), "devolucion_id", "devolucion_en_revision", "dias_hasta_devolucion")
    assert out == [("d1", True, 5), ("d2", None, None)]
    assert "dias_hasta_devolucion" not in derive("fact_devoluciones", back).columns


def test_dictionary_gives_contracts_in_its_own_order(spark):
    lines = [("t", "b", "int64", "PK", 0), ("t", "a", "object", "pk", 1), ("t", "c", "float64", None, 2), ("u", "x", "category", "", 3)]
    df = spark.createDataFrame(lines, "tabla string, campo string, tipo_dato_csv string, rol string, posicion int")
    found = contracts_from(dictionary_rows(df))
    assert found["t"] == TableContract("t", (("b", "bigint"), ("a", "string"), ("c", "double")), ("b", "a"))
    assert found["u"].key == () and found["t"].missing(["a", "z"]) == ["b", "c"]
    assert is_known("t", found) and is_known("manifest", found) and not is_known("otra", found)


def test_merge_keys_fall_back():
    assert merge_keys("fact_inventario_mensual", ["tienda_id", "mes_carga", "producto_id"]) == ["mes_carga", "tienda_id", "producto_id"]
    assert merge_keys("otra", ["x", "y"], TableContract("otra", (), ("y", "x"))) == ["y", "x"]
    # part of a key is no key, nor is the place a row came from
    assert merge_keys("fact_inventario_mensual", ["tienda_id", "mes_carga"]) == ["_tm_record_hash"]
    assert merge_keys("otra", ["x", "_tm_source_path", "_tm_source_year"]) == ["_tm_record_hash"]


def test_whole_numbers_never_round(spark):
    from tidemark.functions.columns import loses_fraction, whole_number
    texts = ["12.0", "12.7", "12.9999999", "-3.99999999999999999999", "9223372036854775807", "x", "", None, " 5 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", whole_number("t").alias("n"), loses_fraction("t").alias("lost"))
    assert [(r.n, r.lost) for r in df.collect()] == [(12, False), (12, True), (12, True), (-3, True), (9223372036854775807, False),
                                                     (None, False), (None, False), (None, False), (5, False)]
