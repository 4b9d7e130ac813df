"""Landing, scans, contracts, validation and run logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from suite.registry import query, table
from suite.sql import define, sql
from suite.tables import month, text
from tidemark import fixed_values as fv
from tidemark.contracts import TableContract, dictionary_rows, dictionary_summary
from tidemark.plans import bronze, silver
from tidemark.plans.settings import Settings
from tidemark.sources import audit
from tidemark.sources.landing import classify
from tidemark.sources.readers import conform, read_csv, read_json, read_parquet
from tidemark.sources.tables import LakeTable
from tidemark.workspace import new_folder

ORDER_CONTRACT = TableContract("orders", (
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
    ("o_orderdate", "string"), ("o_orderpriority", "string")), ("o_orderkey",))
LINE_CONTRACT = TableContract("lineitem", (
    ("l_orderkey", "bigint"), ("l_linenumber", "bigint"), ("l_quantity", "bigint"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_returnflag", "string"), ("l_shipdate", "string")), ("l_orderkey", "l_linenumber"))


def as_text(df: DataFrame) -> DataFrame:
    """A table as a file would hold it."""
    def shown(f):
        c = F.col(f.name)
        return F.date_format(c, "yyyy-MM-dd").alias(f.name) if f.dataType.typeName().startswith("timestamp") else text(f.name)
    return df.select(*[shown(f) for f in df.schema.fields])


# --- landing zone -------------------------------------------------------------------------

define("landed_files", (), """
SELECT o_orderkey, o_orderkey % 8 AS k, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m FROM orders""")
define("landed_paths", ("landed_files",), """
SELECT o_orderkey, k, m, '/lake/raw/comercial/' || y || '/' || CASE
  WHEN k = 0 THEN 'dim_' || o_orderkey || '.csv'
  WHEN k = 1 THEN m || '/fact_' || o_orderkey || '_' || m || '.csv'
  WHEN k = 2 THEN m || '/fact_' || o_orderkey || '.JSON'
  WHEN k = 3 THEN m || '/fact_' || o_orderkey || '_99.parquet'
  WHEN k = 4 THEN m || '/notes_' || o_orderkey || '.xlsx'
  WHEN k = 5 THEN m || '/readme' || o_orderkey
  WHEN k = 6 THEN 'tmp/fact_' || o_orderkey || '.csv'
  ELSE m || '/deep/fact_' || o_orderkey || '.csv' END AS path FROM landed_files""")


@query("land_manifest", sql("""
SELECT path, regexp_extract(path, '[^/]+$') AS archivo, CASE WHEN k > 0 THEN m END AS mes,
  CASE WHEN k = 0 THEN 'full' ELSE 'incremental' END AS modo,
  CASE k WHEN 2 THEN 'json' WHEN 3 THEN 'parquet' WHEN 4 THEN 'xlsx' WHEN 5 THEN NULL ELSE 'csv' END AS formato,
  CASE k WHEN 0 THEN 'dim_' || o_orderkey WHEN 3 THEN 'fact_' || o_orderkey || '_99'
    WHEN 4 THEN 'notes_' || o_orderkey || '.xlsx' WHEN 5 THEN 'readme' || o_orderkey ELSE 'fact_' || o_orderkey END AS tabla,
  CASE k WHEN 4 THEN 'formato_no_soportado' WHEN 5 THEN 'sin_extension' END AS motivo_rechazo
FROM landed_paths WHERE k < 6""", "landed_paths"))
def land_manifest(spark, sf):
    """A listing with one path per order, of every kind a landing zone may hold."""
    key, m = text("o_orderkey"), F.date_format("o_orderdate", "MM")
    k = F.col("o_orderkey") % 8
    name = (
        F.when(k == 0, F.concat(F.lit("dim_"), key, F.lit(".csv")))
        .when(k == 1, F.concat(m, F.lit("/fact_"), key, F.lit("_"), m, F.lit(".csv")))
        .when(k == 2, F.concat(m, F.lit("/fact_"), key, F.lit(".JSON")))
        .when(k == 3, F.concat(m, F.lit("/fact_"), key, F.lit("_99.parquet")))
        .when(k == 4, F.concat(m, F.lit("/notes_"), key, F.lit(".xlsx")))
        .when(k == 5, F.concat(m, F.lit("/readme"), key))
        .when(k == 6, F.concat(F.lit("tmp/fact_"), key, F.lit(".csv")))
        .otherwise(F.concat(m, F.lit("/deep/fact_"), key, F.lit(".csv"))))
    year = F.concat(F.lit("/lake/raw/comercial/"), F.date_format("o_orderdate", "yyyy"))
    listing = table(spark, sf, "orders").select(F.concat(year, F.lit("/"), name).alias("path"))
    return classify(listing, F.regexp_extract("path", "^(/lake/raw/comercial/[0-9]{4})", 1))


# --- scans: whole tables through each format and back ----------------------------------------

@query("scan_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders""")
def scan_csv(spark, sf):
    folder = new_folder(spark, "scan-csv")
    as_text(table(spark, sf, "orders")).write.option("header", True).csv(folder)
    return conform(read_csv(spark, folder, ORDER_CONTRACT.text_struct()), ORDER_CONTRACT)


@query("scan_json", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_json(spark, sf):
    folder = new_folder(spark, "scan-json")
    customers = table(spark, sf, "customer")
    customers.write.json(folder)
    return read_json(spark, folder, customers.schema)


@query("scan_parquet", """
SELECT p_type, p_brand, count(*) AS piezas, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS precio
FROM part WHERE p_size > 10 GROUP BY ALL""")
def scan_parquet(spark, sf):
    """A pruned and filtered scan: four columns are read and the filter reaches the files."""
    part = read_parquet(spark, f"{sf}/part.parquet")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return part.filter("p_size > 10").groupBy("p_type", "p_brand").agg(
        F.count("*").alias("piezas"), F.sum(price).alias("precio"))


# --- contracts --------------------------------------------------------------------------------

@query("dictionary_contracts", """
SELECT CAST(conv_id AS VARCHAR) AS tabla, count(*) AS columnas, count(*) FILTER (role = 'user') AS columnas_clave,
  arg_min(CAST(turn AS VARCHAR), turn) FILTER (role = 'user') AS primera_clave,
  count(*) FILTER (turn % 3 = 0) AS enteros, count(*) FILTER (turn % 3 = 1) AS reales, count(*) FILTER (turn % 3 = 2) AS textos
FROM conversations GROUP BY conv_id""")
def dictionary_contracts(spark, sf):
    """Conversations read as a dictionary: each is a table, its turns are columns, the user's turns its key."""
    turns = table(spark, sf, "conversations")
    declared = F.when(F.col("turn") % 3 == 0, "int64").when(F.col("turn") % 3 == 1, " float64").otherwise("category")
    dictionary = turns.select(
        text("conv_id").alias("tabla"), F.concat(F.lit(" "), text("turn")).alias("campo"), declared.alias("tipo_dato_csv"),
        F.when(F.col("role") == "user", "PK").alias("rol"), F.col("turn").alias("posicion"))
    return dictionary_summary(dictionary_rows(dictionary))


@query("conform_lineitem", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_extendedprice,
  CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_discount END AS l_discount, l_returnflag,
  strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem""")
def conform_lineitem(spark, sf):
    raw = as_text(table(spark, sf, "lineitem"))
    spoilt = F.when(F.col("l_partkey").cast("bigint") % 10 == 0, "?").otherwise(F.col("l_discount"))
    return conform(raw.withColumn("l_discount", spoilt), LINE_CONTRACT)


@query("ingest_metadata", """
SELECT 'comercial' AS area, '2001' AS anio, '07' AS mes, 'incremental' AS modo, strftime(o_orderdate, '%Y-%m') AS mes_carga,
  count(*) AS filas, count(*) AS con_fecha FROM orders GROUP BY ALL""")
def ingest_metadata(spark, sf):
    o = bronze.with_origin(table(spark, sf, "orders"), "comercial", "2001", "07", "incremental")
    return o.groupBy(F.col(fv.AREA).alias("area"), F.col(fv.SOURCE_YEAR).alias("anio"), F.col(fv.SOURCE_MONTH).alias("mes"),
                     F.col(fv.LOAD_MODE).alias("modo"), month("o_orderdate").alias("mes_carga")).agg(
        F.count("*").alias("filas"), F.count(fv.INGESTED_AT).alias("con_fecha"))


SALES_CONTRACT = TableContract("fact_pedidos", (
    ("o_orderkey", "bigint"), ("o_totalprice", "double"), ("mes_carga", "string")), ("o_orderkey",))
CUSTOMER_CONTRACT = TableContract("dim_cliente", (("c_custkey", "bigint"), ("c_segmento", "string")), ("c_custkey",))
EMPTY_CONTRACT = TableContract("dim_vacia", (("s_suppkey", "bigint"),), ("s_suppkey",))
PART_CONTRACT = TableContract("dim_pieza", (("p_partkey", "bigint"), ("p_name", "bigint")), ("p_partkey",))


@query("ingest_rejects", """
SELECT * FROM (
  SELECT 'fact_pedidos' AS tabla, strftime(o_orderdate, '%m') AS mes,
    CASE WHEN strftime(o_orderdate, '%m') = '03' THEN 'FAILED' ELSE 'SUCCESS' END AS estado,
    CASE WHEN strftime(o_orderdate, '%m') = '03' THEN NULL ELSE count(DISTINCT o_orderkey) END AS filas,
    CASE WHEN strftime(o_orderdate, '%m') = '03' THEN 'mes' END AS motivo FROM orders GROUP BY 2)
UNION ALL SELECT 'fact_pedidos', '05', 'FAILED', NULL, 'columnas'
UNION ALL SELECT 'fact_pedidos', '06', 'SUCCESS', count(*), NULL FROM customer
UNION ALL SELECT 'dim_cliente', NULL, 'FAILED', NULL, 'columnas'
UNION ALL SELECT 'dim_desconocida', NULL, 'FAILED', NULL, 'diccionario'
UNION ALL SELECT 'dim_vacia', NULL, 'FAILED', NULL, 'vacia'
UNION ALL SELECT 'dim_pieza', NULL, 'SUCCESS', count(DISTINCT p_partkey), 'celdas' FROM part
UNION ALL SELECT 'notas.xlsx', NULL, 'FAILED', NULL, 'formato'""")
def ingest_rejects(spark, sf):
    """A landed year built from whole tables, good and bad; each batch is loaded or rejected on its own.

    Orders go to the month folder of their date.  In folder 03 every fifth order
    carries another month, so that batch is rejected as a whole.
    """
    root = new_folder(spark, "rejects")
    settings = Settings(root, "comercial", "2001")
    o = table(spark, sf, "orders")
    mm = F.date_format("o_orderdate", "MM")
    stray = (mm == "03") & (F.col("o_orderkey") % 5 == 0)
    landed = o.select(
        "o_orderkey", F.col("o_totalprice"),
        F.concat(F.lit("2001-"), F.when(stray, "04").otherwise(mm)).alias("mes_carga"), mm.alias("mes"))
    landed.write.partitionBy("mes").option("header", True).csv(f"{root}/pedidos")
    customers = table(spark, sf, "customer").select("c_custkey", F.lit("x").alias("otra"))
    for name, df in {"dim_cliente": customers, "dim_desconocida": customers,
                     "dim_vacia": table(spark, sf, "supplier").select("s_suppkey").filter("s_suppkey < 0"),
                     "dim_pieza": table(spark, sf, "part").select("p_partkey", "p_name")}.items():
        df.write.option("header", True).csv(f"{root}/{name}")
    # a second file of a month: one lacks columns, one has them in another order
    customers.write.option("header", True).csv(f"{root}/otros")
    table(spark, sf, "customer").select(
        F.lit("2001-06").alias("mes_carga"), (-F.col("c_custkey")).alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice")
    ).write.option("header", True).csv(f"{root}/negativos")
    second = {5: (f"{root}/otros",), 6: (f"{root}/negativos",)}
    contracts = {c.name: c for c in (SALES_CONTRACT, CUSTOMER_CONTRACT, EMPTY_CONTRACT, PART_CONTRACT)}
    batches = [bronze.Batch("fact_pedidos", f"{m:02d}", "incremental", "csv", (f"{root}/pedidos/mes={m:02d}", *second.get(m, ())))
               for m in range(1, 13)]
    batches += [bronze.Batch(t, None, "full", "csv", (f"{root}/{t}",))
                for t in ("dim_cliente", "dim_desconocida", "dim_vacia", "dim_pieza")]
    batches.append(bronze.Batch("notas.xlsx", None, "full", "xlsx", (f"{root}/notas.xlsx",)))
    results = bronze.load_batches(spark, settings, contracts, batches)
    reason = (
        F.when(F.col("error_message").contains("outside"), "mes").when(F.col("error_message").contains("missing"), "columnas")
        .when(F.col("error_message").contains("dictionary"), "diccionario").when(F.col("error_message").contains("no rows"), "vacia")
        .when(F.col("error_message").contains("cells"), "celdas").when(F.col("error_message").contains("format"), "formato"))
    return results.select(F.col("table_name").alias("tabla"), F.col("source_month").alias("mes"),
                          F.col("status").alias("estado"), F.col("record_count").alias("filas"), reason.alias("motivo"))


def written_lines(df: DataFrame, line, columns: str, folder: str) -> None:
    """Text lines below a header line, as files of a landing zone hold them."""
    df.select(line.alias(columns)).write.option("header", True).option("sep", "\x01").option("quote", "").csv(folder)


# every 17th line is broken: a cell too many, a cell too few, a quote that never ends; half an object, plain text, a bare number
define("order_lines", (), """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s,
  CASE WHEN o_orderkey % 17 = 0 THEN (o_orderkey // 17) % 3 END AS kind FROM orders""")


@query("malformed_rows", sql("""
SELECT 'cargada' AS que, f AS formato, o_orderkey AS clave, c || s AS contenido, NULL AS motivo, CAST(NULL AS BIGINT) AS filas
FROM order_lines, (VALUES ('csv'), ('json')) formats(f) WHERE kind IS NULL
UNION ALL SELECT 'rechazada', 'csv', NULL,
  CASE kind WHEN 0 THEN k || ',' || c || ',' || s || ',x' WHEN 1 THEN k || ',' || c ELSE '"' || k || ',' || c || ',' || s END,
  CASE kind WHEN 0 THEN '3 cells expected, found 4' WHEN 1 THEN '3 cells expected, found 2' ELSE 'cells cannot be told apart' END, NULL
FROM order_lines WHERE kind IS NOT NULL
UNION ALL SELECT 'rechazada', 'json', NULL, CASE kind WHEN 0 THEN '{"o_orderkey":"' || k WHEN 1 THEN 'pedido ' || k ELSE k END, 'no JSON object', NULL
FROM order_lines WHERE kind IS NOT NULL
UNION ALL SELECT 'registro', f, NULL, 'SUCCESS', count(kind) || ' lines rejected', count(*) - count(kind)
FROM order_lines, (VALUES ('csv'), ('json')) formats(f) GROUP BY f""", "order_lines"))
def malformed_rows(spark, sf):
    """All orders land as csv and as json, every 17th line broken: what was loaded, what was rejected and why, and the log."""
    root = new_folder(spark, "malformed")
    settings = Settings(root, "comercial", "2001")
    key, cust, status = text("o_orderkey"), text("o_custkey"), F.col("o_orderstatus")
    broken, kind = F.col("o_orderkey") % 17 == 0, F.expr("(o_orderkey div 17) % 3")
    o = table(spark, sf, "orders")
    whole = F.concat_ws(",", key, cust, status)
    written_lines(o, F.when(~broken, whole).when(kind == 0, F.concat(whole, F.lit(",x"))).when(kind == 1, F.concat_ws(",", key, cust))
                  .otherwise(F.concat(F.lit('"'), whole)), "o_orderkey,o_custkey,o_orderstatus", f"{root}/pedidos csv")
    whole = F.to_json(F.struct(key.alias("o_orderkey"), cust.alias("o_custkey"), "o_orderstatus"))
    o.select(F.when(~broken, whole).when(kind == 0, F.concat(F.lit('{"o_orderkey":"'), key)).when(kind == 1, F.concat(F.lit("pedido "), key))
             .otherwise(key)).write.text(f"{root}/pedidos%20json")
    columns = (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"))
    contracts = {f"pedidos_{fmt}": TableContract(f"pedidos_{fmt}", columns, ("o_orderkey",)) for fmt in ("csv", "json")}
    batches = [bronze.Batch("pedidos_csv", None, "full", "csv", (f"{root}/pedidos csv",)),
               bronze.Batch("pedidos_json", None, "full", "json", (f"{root}/pedidos%20json",))]
    log = bronze.load_batches(spark, settings, contracts, batches)
    null = F.lit(None)

    def loaded(fmt: str) -> DataFrame:
        rows = LakeTable(spark, settings.table_path("bronze", f"pedidos_{fmt}"), bronze.PARTITIONS).read()
        return rows.select(F.lit("cargada").alias("que"), F.lit(fmt).alias("formato"), F.col("o_orderkey").alias("clave"),
                           F.concat("o_custkey", "o_orderstatus").alias("contenido"), null.cast("string").alias("motivo"), null.cast("bigint").alias("filas"))

    fmt = F.element_at(F.split("table_name", "_"), -1)
    rejected = bronze.rejected_lines(spark, settings).select(F.lit("rechazada"), fmt, null.cast("bigint"), "line", "reason", null.cast("bigint"))
    logged = log.select(F.lit("registro"), fmt, null.cast("bigint"), "status", "error_message", "record_count")
    return loaded("csv").union(loaded("json")).union(rejected).union(logged)


@query("month_alignment_violations", """
SELECT strftime(o_orderdate, '%Y-%m') || '-01' AS mes_carga, count(*) AS filas FROM orders
WHERE o_orderkey % 4 = 0 AND strftime(o_orderdate, '%Y-%m') <> '1998-03' GROUP BY 1""")
def month_alignment_violations(spark, sf):
    """All orders in the folder of 1998-03, every fourth with its true month: which months do not belong there?"""
    true_month = F.concat(month("o_orderdate"), F.lit("-01"))
    claimed = F.when(F.col("o_orderkey") % 4 == 0, true_month).when(F.col("o_orderkey") % 4 == 1, " 1998-03 ") \
        .when(F.col("o_orderkey") % 4 == 2, "1998-03-17")
    return bronze.month_violations(table(spark, sf, "orders").select(claimed.alias(fv.MONTH)), "1998-03")


# --- run logs -----------------------------------------------------------------------------------

def load_log(spark, sf) -> DataFrame:
    """A load log with one load per customer and year of orders, clocked by the orders themselves."""
    loads = table(spark, sf, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy").alias("y")).agg(
        F.count("*").alias("n"), F.max("o_orderdate").cast("timestamp").alias("at"), F.max("o_orderkey").alias("top"))
    cust = text("o_custkey")
    path = F.concat(F.lit("raw/"), "y", F.lit("/c_"), cust, F.lit(".csv"))
    null = F.lit(None)
    done = F.when(F.col("top") % 3 == 0, fv.FAILED).otherwise(fv.SUCCESS)
    archived = (F.col("top") % 3 == 1) & (F.col("top") % 2 == 0)
    columns = dict(
        load_id=F.concat_ws("-", "o_custkey", "y"), area=F.lit("comercial"), table_name=F.concat(F.lit("c_"), cust),
        load_mode=F.lit("full"), source_year=F.col("y"), source_month=null.cast("string"), source_path=path,
        source_file_name=F.concat(F.lit("c_"), cust, F.lit(".csv")), source_format=F.lit("csv"),
        target_table=F.concat(F.lit("bronze.c_"), cust), target_path=F.lit("bronze"), record_count=F.col("n"),
        status=done, error_message=F.when(done == fv.FAILED, "roto"), historic_path=F.concat(F.lit("historic/"), path),
        archived_at=F.when(archived, F.col("at")), archive_status=F.when(archived, fv.ARCHIVED),
        archive_error_message=null.cast("string"), created_at=F.col("at"), updated_at=F.col("at"))
    return loads.select(*[c.alias(n) for n, c in columns.items()])


define("load_log", (), """
SELECT CAST(o_custkey AS VARCHAR) || '-' || y AS load_id, 'c_' || o_custkey AS table_name, y AS source_year, n AS record_count, t, top,
  CASE WHEN top % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, top % 3 = 1 AND top % 2 = 0 AS archived,
  'raw/' || y || '/c_' || o_custkey || '.csv' AS source_path
FROM (SELECT o_custkey, strftime(o_orderdate, '%Y') AS y, count(*) AS n, max(o_orderdate) AS t, max(o_orderkey) AS top
      FROM orders GROUP BY ALL)""")


@query("audit_latest", sql("""
SELECT table_name, load_id, status, record_count, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY t DESC) AS rn FROM load_log) WHERE rn = 1""", "load_log"))
def audit_latest(spark, sf):
    return audit.latest_per(load_log(spark, sf), "table_name").select(
        "table_name", "load_id", "status", "record_count", "updated_at")


@query("pending_archives", sql("""
SELECT load_id, table_name, source_year, source_path FROM load_log WHERE status = 'SUCCESS' AND NOT archived""", "load_log"))
def pending_archives(spark, sf):
    return audit.in_archive_order(audit.pending_archives(load_log(spark, sf))).select(
        "load_id", "table_name", "source_year", "source_path")


@query("archive_status_update", sql("""
SELECT load_id, status, CASE WHEN y >= '1998' AND odd THEN 'SUCCESS' WHEN archived THEN 'SUCCESS' END AS archive_status,
  strftime(CASE WHEN y >= '1998' AND odd THEN TIMESTAMP '2002-01-02' WHEN archived THEN t END, '%Y-%m-%d %H:%M:%S.%f') AS archived_at,
  strftime(CASE WHEN y >= '1998' AND odd THEN TIMESTAMP '2002-01-02' ELSE t END, '%Y-%m-%d %H:%M:%S.%f') AS updated_at
FROM (SELECT *, source_year AS y, CAST(split_part(load_id, '-', 1) AS BIGINT) % 2 = 1 AS odd FROM load_log)""", "load_log"))
def archive_status_update(spark, sf):
    """Odd customers' loads since 1998 get archived; each update comes twice and some match no load."""
    log = load_log(spark, sf)
    odd = table(spark, sf, "customer").filter("c_custkey % 2 = 1").select("c_custkey")
    years = F.explode(F.sequence(F.lit(1998), F.lit(2005))).alias("y")
    each = odd.select("c_custkey", years).select(F.concat_ws("-", "c_custkey", "y").alias("load_id"))

    def told(day: int, status: str) -> DataFrame:
        at = F.lit(datetime(2002, 1, day)).cast("timestamp")
        return each.select("load_id", at.alias("archived_at"), F.lit(status).alias("archive_status"),
                           F.lit(None).cast("string").alias("archive_error_message"), at.alias("updated_at"))

    updates = told(1, fv.FAILED).unionByName(told(2, fv.ARCHIVED))
    return audit.apply_archive_updates(log, updates).select("load_id", "status", "archive_status", "archived_at", "updated_at")


@query("archive_state", sql("""
SELECT load_id, table_name, CASE WHEN NOT landed AND NOT historic THEN 'FAILED' ELSE 'SUCCESS' END AS archive_status, landed AS por_mover,
  CASE WHEN NOT landed AND NOT historic THEN 'el archivo no esta en raw ni en historico' END AS archive_error_message
FROM (SELECT *, record_count >= 2 AS landed, top % 4 = 1 AS historic FROM load_log WHERE status = 'SUCCESS' AND NOT archived)""", "load_log"))
def archive_state(spark, sf):
    """Pending files against two listings: loads of two or more rows are still landed, some are already historic."""
    log = load_log(spark, sf)
    landed = log.filter("record_count >= 2").select(F.col("source_path").alias("path"))
    top = table(spark, sf, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy").alias("y")).agg(
        F.max("o_orderkey").alias("top"))
    historic = top.filter("top % 4 = 1").select(
        F.concat(F.lit("historic/raw/"), "y", F.lit("/c_"), text("o_custkey"), F.lit(".csv")).alias("path"))
    return audit.archive_outcomes(audit.pending_archives(log), landed, historic).select(
        "load_id", "table_name", "archive_status", "por_mover", "archive_error_message")


def step_log(spark, sf) -> DataFrame:
    """A step log with one run per day and event type, clocked by the events."""
    runs = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.max("ts").cast("timestamp").alias("top"),
        F.count_if(F.col("value") > 50).alias("kept"))
    failed = F.dayofmonth("day") % 5 == 0
    columns = dict(
        environment=F.lit("dev"), domain_name=F.lit("comercial"),
        step_name=F.when(F.dayofmonth("day") % 2 == 0, fv.STEPS[0]).otherwise(fv.STEPS[1]), table_name=F.col("event_type"),
        source_table=F.lit("bronze"), target_table=F.lit("silver"), input_rows=F.col("n"), output_rows=F.col("kept"),
        status=F.when(failed, fv.FAILED).otherwise(fv.SUCCESS), message=F.when(failed, "roto"),
        watermark_column=F.lit(fv.INGESTED_AT), previous_watermark=F.lit(None).cast("timestamp"), new_watermark=F.col("top"),
        target_path=F.lit("silver"), created_at=F.col("top"), updated_at=F.col("top"))
    return runs.select(*[c.alias(n) for n, c in columns.items()])


define("step_log", (), """
SELECT event_type AS table_name, count(*) AS input_rows, count(*) FILTER (value > 50) AS output_rows,
  max(ts) AS top, CASE WHEN day(ts) % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN day(ts) % 2 = 0 THEN 'schema_standardization' ELSE 'null_corrections' END AS step_name
FROM events GROUP BY event_type, CAST(ts AS DATE), day(ts)""")


@query("watermark_state", sql("""
SELECT step_name, table_name, strftime(max(top), '%Y-%m-%d %H:%M:%S.%f') AS watermark FROM step_log WHERE status = 'SUCCESS'
GROUP BY ALL""", "step_log"))
def watermark_state(spark, sf):
    return audit.high_water_marks(step_log(spark, sf))


@query("step_summary", sql("""
SELECT step_name, table_name, status, input_rows, output_rows, CAST(NULL AS VARCHAR) AS previous_watermark,
  strftime(top, '%Y-%m-%d %H:%M:%S.%f') AS new_watermark, 'silver' AS target_path,
  CASE WHEN status = 'FAILED' THEN 'roto' END AS message FROM step_log""", "step_log"))
def step_summary(spark, sf):
    return audit.step_summary(step_log(spark, sf))


@query("mixed_format_months", """
SELECT o_orderkey, o_custkey, 3 - CAST(o_orderkey % 3 = 1 AS BIGINT) AS mes FROM orders""")
def mixed_format_months(spark, sf):
    """Orders land as json in January, two thirds of them as csv in February, and all but one third as json in March.

    The latest month of a key wins, whatever the formats.
    """
    root = new_folder(spark, "mixed")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    o.withColumn("mes", F.lit(1)).write.json(f"{root}/01")
    o.filter("o_orderkey % 3 <> 0").withColumn("mes", F.lit(2)).write.option("header", True).csv(f"{root}/02")
    o.filter("o_orderkey % 3 <> 1").withColumn("mes", F.lit(3)).write.json(f"{root}/03")
    contract = TableContract("fact_mixta", (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("mes", "bigint")), ("o_orderkey",))
    batches = [bronze.Batch(contract.name, m, "incremental", fmt, (f"{root}/{m}",)) for m, fmt in (("01", "json"), ("02", "csv"), ("03", "json"))]
    settings = Settings(root, "comercial", "2001")
    bronze.raise_on_failures(bronze.load_batches(spark, settings, {contract.name: contract}, batches))
    return LakeTable(spark, settings.table_path("bronze", contract.name), bronze.PARTITIONS).read().select(*contract.column_names)


@query("silver_dictionary_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def silver_dictionary_table(spark, sf):
    """All orders through bronze and silver as a table that only the dictionary knows."""
    root = new_folder(spark, "dictionary")
    as_text(table(spark, sf, "orders")).select(*ORDER_CONTRACT.column_names).write.option("header", True).csv(f"{root}/orders")
    contracts, settings = {"orders": ORDER_CONTRACT}, Settings(root, "comercial", "2001")
    bronze.raise_on_failures(bronze.load_batches(
        spark, settings, contracts, [bronze.Batch("orders", None, "full", "csv", (f"{root}/orders",))]))
    silver.refresh(spark, settings, contracts)
    return LakeTable(spark, settings.table_path("silver", "orders"), bronze.PARTITIONS).read().select(*ORDER_CONTRACT.column_names)
