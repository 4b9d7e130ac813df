"""Deduplication, hashing, upserts, publication and incremental refreshes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from suite.registry import query, table
from suite.sql import sql
from suite.tables import LINE_KEY, LINE_NEWEST, base_lake, money, month
from tidemark import fixed_values as fv
from tidemark.operators.dedup import distinct_records, keyed_batch, latest_by_key, with_hash_key
from tidemark.operators.upsert import keyed_upsert
from tidemark.contracts import TableContract
from tidemark.plans import silver
from tidemark.plans.settings import Settings
from tidemark.plans.silver import newer_than
from tidemark.sources import audit
from tidemark.sources.tables import EmptyPublication, LakeTable
from tidemark.streaming.incremental import upsert_new_files
from tidemark.streaming.silver import refresh_new_rows
from tidemark.workspace import new_folder

PARTS = (fv.SOURCE_YEAR, fv.SOURCE_MONTH)


@query("dedup_latest", sql("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate FROM newest""", "newest"))
def dedup_latest(spark, sf):
    return latest_by_key(table(spark, sf, "lineitem"), LINE_KEY, LINE_NEWEST)


@query("record_hash", """
SELECT l_returnflag, l_linestatus, count(*) AS registros FROM (SELECT DISTINCT * FROM lineitem) GROUP BY ALL""")
def record_hash(spark, sf):
    """Every line arrives twice; the hash key brings them back to the distinct lines."""
    li = table(spark, sf, "lineitem")
    batch, _ = keyed_batch(li.unionAll(li), ())
    return batch.groupBy("l_returnflag", "l_linestatus").agg(F.count(fv.RECORD_HASH).alias("registros"))


def landed(df: DataFrame, date: str, wave: datetime) -> DataFrame:
    """Orders with the technical columns of a load: folder year and month, time of ingestion."""
    return df.withColumns({
        fv.SOURCE_YEAR: F.date_format(date, "yyyy"), fv.SOURCE_MONTH: F.date_format(date, "MM"),
        fv.INGESTED_AT: F.lit(wave).cast("timestamp")})


FIRST, SECOND = datetime(2002, 1, 1), datetime(2002, 2, 1)


@query("bronze_upsert_pk", """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') AS anio, strftime(o_orderdate, '%m') AS mes,
  CASE WHEN o_orderkey % 3 = 0 THEN 1.5 ELSE o_totalprice END AS o_totalprice FROM orders""")
def bronze_upsert_pk(spark, sf):
    """Even orders are loaded, then the odd ones, and every third order with a new price; stored by source year and month."""
    o = table(spark, sf, "orders")
    target = LakeTable(spark, new_folder(spark, "bronze-pk"), PARTS)
    target.upsert(landed(o.filter("o_orderkey % 2 = 0"), "o_orderdate", FIRST), ["o_orderkey"])
    new_price = F.when(F.col("o_orderkey") % 3 == 0, 1.5).otherwise(F.col("o_totalprice"))
    repriced = o.filter("o_orderkey % 2 = 1 OR o_orderkey % 3 = 0").withColumn("o_totalprice", new_price)
    target.upsert(landed(repriced, "o_orderdate", SECOND), ["o_orderkey"])
    return target.read().select("o_orderkey", "o_orderstatus", F.col(fv.SOURCE_YEAR).alias("anio"),
                                F.col(fv.SOURCE_MONTH).alias("mes"), "o_totalprice")


@query("bronze_upsert_hash", """
SELECT strftime(l_shipdate, '%Y') AS anio, count(*) AS registros, count(*) AS claves,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS importe FROM (SELECT DISTINCT * FROM lineitem) GROUP BY 1""")
def bronze_upsert_hash(spark, sf):
    """Lines have no usable key: they are loaded by record hash, and loaded again without any effect."""
    target = LakeTable(spark, new_folder(spark, "bronze-hash"), (fv.SOURCE_YEAR,))
    for wave in (FIRST, SECOND):
        arrived = table(spark, sf, "lineitem").withColumns({
            fv.SOURCE_YEAR: F.date_format("l_shipdate", "yyyy"), fv.INGESTED_AT: F.lit(wave).cast("timestamp")})
        batch, key = keyed_batch(arrived, ())
        target.upsert(batch, key)
    loaded = target.read().withColumnRenamed(fv.SOURCE_YEAR, "anio")
    figures = loaded.groupBy("anio").agg(F.count("*").alias("registros"), F.sum(money("l_extendedprice")).alias("importe"))
    found = distinct_records(loaded, "anio").withColumnRenamed("anio", "_anio")
    return figures.join(found, F.col("anio").eqNullSafe(F.col("_anio")), "left").select(
        "anio", "registros", F.coalesce("registros_distintos", F.lit(0)).alias("claves"), "importe")


@query("schema_evolution_upsert", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 OR o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 2 = 1 OR o_orderkey % 5 = 0 THEN o_orderpriority END AS prioridad FROM orders""")
def schema_evolution_upsert(spark, sf):
    """The second batch lacks a column (updated rows lose it) and brings a new one (old rows lack it)."""
    o = table(spark, sf, "orders")
    target = LakeTable(spark, new_folder(spark, "evolve"))
    target.upsert(o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_orderkey"])
    rest = o.filter("o_orderkey % 2 = 1 OR o_orderkey % 5 = 0")
    target.upsert(rest.select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("prioridad")),
                  ["o_orderkey"])
    return target.read()


@query("upsert_plan", """
SELECT o_custkey, CASE WHEN n IS NULL THEN NULL ELSE n END AS pedidos, origen FROM (
  SELECT c_custkey AS o_custkey, CASE WHEN p.n IS NULL THEN 0 ELSE p.n END AS n,
    CASE WHEN p.n IS NULL THEN 'maestro' ELSE 'pedidos' END AS origen
  FROM (SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS c_custkey FROM customer WHERE c_custkey % 50 > 0
        UNION ALL SELECT NULL) c
  LEFT JOIN (SELECT CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_custkey END AS k, count(*) AS n FROM orders GROUP BY 1) p
    ON c_custkey IS NOT DISTINCT FROM k)""")
def upsert_plan(spark, sf):
    """The merge as one lazy plan, with a NULL key that matches itself: customers, updated by their order counts."""
    def key(c: str):
        return F.when(F.col(c) % 50 == 0, None).otherwise(F.col(c)).alias("o_custkey")
    master = table(spark, sf, "customer").select(key("c_custkey")).distinct().select(
        "o_custkey", F.lit(0).cast("bigint").alias("pedidos"), F.lit("maestro").alias("origen"))
    counted = table(spark, sf, "orders").groupBy(key("o_custkey")).agg(F.count("*").alias("pedidos")).withColumn(
        "origen", F.lit("pedidos"))
    return keyed_upsert(master, counted, ["o_custkey"])


@query("late_upsert", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '1995-01' ELSE strftime(o_orderdate, '%Y-%m') END AS mes,
  CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def late_upsert(spark, sf):
    """All orders, then corrections that arrive later but lie in an older month folder: the last ingestion wins."""
    o = table(spark, sf, "orders")
    target = LakeTable(spark, new_folder(spark, "late"), PARTS)
    target.upsert(landed(o, "o_orderdate", FIRST), ["o_orderkey"])
    late = landed(o.filter("o_orderkey % 4 = 0"), "o_orderdate", SECOND).withColumns({
        fv.SOURCE_YEAR: F.lit("1995"), fv.SOURCE_MONTH: F.lit("01"), "o_orderstatus": F.lit("X")})
    # the correction and an older copy of it arrive in the same batch
    stale = late.withColumns({fv.INGESTED_AT: F.lit(FIRST).cast("timestamp"), "o_orderstatus": F.lit("viejo")})
    target.upsert(latest_by_key(stale.unionByName(late), ["o_orderkey"]), ["o_orderkey"])
    return target.read().select("o_orderkey", F.concat_ws("-", fv.SOURCE_YEAR, fv.SOURCE_MONTH).alias("mes"), "o_orderstatus")


@query("publish_gate", """
SELECT 1 AS publicacion, o_orderkey, o_orderstatus FROM orders
UNION ALL SELECT 2, o_orderkey, o_orderstatus FROM orders
UNION ALL SELECT 3, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def publish_gate(spark, sf):
    """What readers see after each publication: all orders, then still all (an empty one is refused), then the finished ones."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    target, seen = LakeTable(spark, new_folder(spark, "publish")), []
    for n, wanted in enumerate(("true", "o_orderkey < 0", "o_orderstatus = 'F'"), 1):
        try:
            target.publish(o.filter(wanted))
        except EmptyPublication:
            pass
        seen.append(target.read().withColumn("publicacion", F.lit(n)))
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


# --- incremental ------------------------------------------------------------------------------

@query("incremental_new_rows", """
SELECT event_type, count(*) AS filas, min(event_id) AS primero, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS valor
FROM events WHERE ts > TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1""")
def incremental_new_rows(spark, sf):
    """Events ingested when they happened; the second run sees only those above the first run's mark."""
    events = table(spark, sf, "events").withColumn(fv.INGESTED_AT, F.col("ts"))
    fresh = newer_than(events, datetime(2024, 1, 16))
    return fresh.groupBy("event_type").agg(F.count("*").alias("filas"), F.min("event_id").alias("primero"),
                                           F.sum(money("value")).alias("valor"))


LOADS = 6


def stamped_loads(spark, sf) -> LakeTable:
    """All events in a table of ``LOADS`` loads by id, each ingested in its own month."""
    events, target = table(spark, sf, "events"), LakeTable(spark, new_folder(spark, "stamped"))
    for load in range(LOADS):
        target.append(events.filter(F.col("event_id") % LOADS == load).withColumn(
            fv.INGESTED_AT, F.lit(datetime(2002, load + 1, 1)).cast("timestamp")))
    return target


@query("incremental_pushed_mark", f"""
SELECT event_type, count(*) AS filas, min(event_id) AS primero, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS valor
FROM events WHERE event_id % {LOADS} > 3 GROUP BY 1""")
def incremental_pushed_mark(spark, sf):
    """Rows above the mark of the fourth of six loads: the filter reaches the files, whose statistics rule out older row groups."""
    fresh = newer_than(stamped_loads(spark, sf).read(), datetime(2002, 4, 1))
    return fresh.groupBy("event_type").agg(F.count("*").alias("filas"), F.min("event_id").alias("primero"),
                                           F.sum(money("value")).alias("valor"))


@query("step_rows_measured", """
WITH l AS (SELECT DISTINCT * FROM lineitem), n AS (SELECT count(*) AS arrived, count(DISTINCT (l_orderkey, l_linenumber)) AS kept,
  count(DISTINCT (l_orderkey, l_linenumber)) FILTER (l_orderkey % 3 = 0) AS waiting FROM l)
SELECT 1 AS corrida, 'schema_standardization' AS paso, 'SUCCESS' AS estado, arrived AS entran, kept AS salen FROM n
UNION ALL SELECT 1, unnest(['null_corrections', 'domain_normalization', 'business_derivations']), 'SUCCESS', kept, kept FROM n
UNION ALL SELECT 2, 'schema_standardization', 'NO_DATA', 0, 0
UNION ALL SELECT 2, 'null_corrections', 'NO_DATA', 0, 0
UNION ALL SELECT 2, unnest(['domain_normalization', 'business_derivations']), 'SUCCESS', waiting, waiting FROM n""")
def step_rows_measured(spark, sf):
    """Rows in and out of every silver step, as observed: all lines, then a third of them that wait after the second step."""
    settings = Settings(new_folder(spark, "steps"), "comercial", "2001")
    contract = TableContract("lineas", (("l_orderkey", "bigint"), ("l_linenumber", "bigint")), tuple(LINE_KEY))
    batch, key = keyed_batch(table(spark, sf, "lineitem").withColumns({
        fv.SOURCE_YEAR: F.lit("2001"), fv.SOURCE_MONTH: F.lit(None).cast("string"), fv.INGESTED_AT: F.lit(FIRST).cast("timestamp")}), ())
    LakeTable(spark, settings.table_path("bronze", contract.name), PARTS).upsert(batch, key)
    silver.refresh(spark, settings, {contract.name: contract})
    lines = LakeTable(spark, settings.table_path("silver", contract.name), PARTS)
    stopped = lines.read().filter("l_orderkey % 3 = 0").withColumn(fv.SILVER_STEP, F.lit(fv.STEPS[1]))
    lines.upsert(stopped, LINE_KEY)
    silver.refresh(spark, settings, {contract.name: contract})
    log = audit.read(spark, settings.log_path("silver"), audit.STEP_LOG)
    run = F.dense_rank().over(Window.orderBy("created_at"))  # eight rows
    return log.select(run.alias("corrida"), F.col("step_name").alias("paso"), F.col("status").alias("estado"),
                      F.col("input_rows").alias("entran"), F.col("output_rows").alias("salen"))


@query("late_sales_for_returns", sql("""
SELECT devolucion_id, dias_hasta_devolucion, 'business_derivations' AS paso FROM back""", "back"))
def late_sales_for_returns(spark, sf):
    """All returns reach silver before any sale; when the sales come, the open lookups are found and derived again."""
    settings = Settings(new_folder(spark, "late-sales"), "comercial", "2001")
    lake = base_lake(spark, sf, staged="lines")
    origin = {fv.SOURCE_YEAR: F.lit("2001"), fv.SOURCE_MONTH: F.lit(None).cast("string"), fv.INGESTED_AT: F.current_timestamp()}
    for name in ("fact_devoluciones", "fact_ventas_cabecera"):
        rows = lake[name].withColumns(origin)
        LakeTable(spark, settings.table_path("bronze", name), PARTS).upsert(rows, fv.PRIMARY_KEYS[name])
        silver.refresh(spark, settings, ["fact_devoluciones", "fact_ventas_cabecera"])
    returned = LakeTable(spark, settings.table_path("silver", "fact_devoluciones"), PARTS).read()
    return returned.select("devolucion_id", F.col("dias_hasta_devolucion").cast("bigint"), F.col(fv.SILVER_STEP).alias("paso"))


@query("silver_available_now", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, 'business_derivations' AS paso,
  (SELECT 2 * count(*) - count(*) FILTER (o_orderkey % 5 <> 0) FROM orders) AS entraron FROM orders""")
def silver_available_now(spark, sf):
    """All orders in two loads, every fifth corrected by the second, carried to silver by a stream that ends when it has caught up."""
    settings = Settings(new_folder(spark, "silver-stream"), "comercial", "2001")
    contract = TableContract("pedidos", (("o_orderkey", "bigint"), ("o_orderstatus", "string")), ("o_orderkey",))
    o, source = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), LakeTable(
        spark, settings.table_path("bronze", contract.name), PARTS)
    for wave, rows in ((FIRST, o), (SECOND, o.filter("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("X")))):
        source.upsert(landed(rows, "o_orderdate", wave), contract.key)
        refresh_new_rows(spark, settings, contract.name, f"{settings.root}/checkpoint", contract).awaitTermination()
    log = audit.read(spark, settings.log_path("silver"), audit.STEP_LOG).filter(F.col("step_name") == fv.STEPS[0])
    came = log.agg(F.sum("input_rows").alias("entraron"))
    done = LakeTable(spark, settings.table_path("silver", contract.name), PARTS).read()
    return done.select("o_orderkey", "o_orderstatus", F.col(fv.SILVER_STEP).alias("paso")).join(F.broadcast(came))


@query("incremental_available_now", """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def incremental_available_now(spark, sf):
    """Two waves of event files merged by a stream that ends when it has caught up: latest event per user and type."""
    root = new_folder(spark, "stream")
    events = table(spark, sf, "events")
    target = LakeTable(spark, f"{root}/target")
    for wave in (events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")):
        wave.write.mode("append").parquet(f"{root}/landing")
        # a later wave may hold older events than the table: newest of batch and table wins
        run = upsert_new_files(spark, f"{root}/landing", events.schema, target, ["user_id", "event_type"], f"{root}/checkpoint",
                               newest=("ts", "event_id"), keep_newest=True)
        run.awaitTermination()
    return target.read().select("user_id", "event_type", "event_id", "value")
