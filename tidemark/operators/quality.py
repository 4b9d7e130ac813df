"""Data-quality checks: one row per check, computed without leaving Spark.

All counting checks of a table share one aggregation over it, and all references
of all tables another; key uniqueness needs a grouping of its own.  Nothing is collected: the report
is a union of one-row frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import fixed_values as fv

CHECK_SCHEMA = "table_name string, check_name string, severity string, failing_count bigint, description string"


def _labelled(counts: DataFrame, table: str, name: str, description: str, severity: str = "ERROR") -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        F.col("failing_count").cast("bigint").alias("failing_count"), F.lit(description).alias("description"))


def key_text(keys: Sequence[str]) -> str:
    return ", ".join(keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def unique_key(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of duplicated key *values*."""
    counts = duplicate_keys(df, keys).agg(F.count("*").alias("failing_count"))
    return _labelled(counts, table, "primary_key_unique", f"PK unica por {key_text(keys)}")


def key_checks(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key uniqueness, null keys and emptiness from one grouping by the key."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_rows")).select(any_null.alias("_null"), "_rows")
    found = per_key.agg(F.count_if(F.col("_rows") > 1).alias("_twice"),
                        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_rows"))), F.lit(0)).alias("_nulls"),
                        F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint").alias("_empty"))
    results = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(said).alias("description"), F.col(c).alias("failing_count"))
                        for (name, said), c in zip(_key_check_names(keys), ("_twice", "_nulls", "_empty"))])
    return _as_checks(found.select(F.inline(results)), table)


def _key_check_names(keys: Sequence[str]) -> list[tuple[str, str]]:
    return [("primary_key_unique", f"PK unica por {key_text(keys)}"), ("primary_key_not_null", f"PK no nula por {key_text(keys)}"),
            ("table_not_empty", "La tabla Silver debe tener registros")]


def _as_checks(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(F.lit(table).alias("table_name"), "check_name", F.lit("ERROR").alias("severity"),
                       F.col("failing_count").cast("bigint").alias("failing_count"), "description")


def row_checks(table: str, df: DataFrame, keys: Sequence[str] = (),
               identities: Sequence[tuple[str, str, float]] = (), emptiness: bool = True) -> DataFrame:
    """Null keys, emptiness and arithmetic identities of one table in a single pass."""
    names, counters = [], []
    if keys:
        names.append(("primary_key_not_null", f"PK no nula por {key_text(keys)}"))
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        counters.append(F.count_if(any_null))
    if emptiness:
        names.append(("table_not_empty", "La tabla Silver debe tener registros"))
        counters.append(F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint"))
    for description, residual, tolerance in identities:
        names.append(("arithmetic_consistency", description))
        counters.append(F.count_if(F.abs(F.expr(residual).cast("double")) > tolerance))
    one_row = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counters)])
    results = F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.lit(d).alias("description"), F.col(f"_{i}").alias("failing_count"))
        for i, (n, d) in enumerate(names)])
    return _as_checks(one_row.select(F.inline(results)), table)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null references that the parent does not have.

    The distinct comes first: a reference shared by a third of all rows reaches
    the join as one row.
    """
    wanted = child.filter(F.col(column).isNotNull()).select(F.col(column).alias("referencia")).distinct()
    known = parent.select(F.col(parent_column).alias("_known"))
    return wanted.join(known, F.col("referencia") == F.col("_known"), "left_anti")


def reference_check(child_name: str, child: DataFrame, column: str,
                    parent_name: str, parent: DataFrame, parent_column: str) -> DataFrame:
    counts = orphans(child, column, parent, parent_column).agg(F.count("*").alias("failing_count"))
    return _labelled(counts, child_name, f"fk_{column}_to_{parent_name}_{parent_column}",
                     "Integridad referencial Silver")


TAGS = 62  # references that share one mark


def reference_checks(references: Sequence[tuple[str, str, str, str]], tables: Mapping[str, DataFrame],
                     parents: Mapping[str, DataFrame], keyed: Mapping[str, str] | None = None) -> DataFrame:
    """All references (child, column, parent, parent column) in one pass: distinct orphans of each.

    Every table is read once and gives its values tagged: by the parent key they should be
    found in, and by a bit of the reference or none for the parent's own values.  One grouping by key and
    value joins all sides, combined before it is shuffled, so a value held by a third of all rows is one row
    a task.  A value of another type than the parent's is compared as the parent's type.

    ``keyed`` names parents and the column of theirs that is their key as well as what references look for
    (``checked_as_parents`` finds them): the same grouping then gives their checks of the key, which need no other.
    """
    keyed = keyed or {}
    members: dict[tuple[str, str], list[int]] = {}
    for i, (_, _, parent, parent_column) in enumerate(references):
        members.setdefault((parent, parent_column), []).append(i)
    frames = {**{p: parents[p] for p, _ in members}, **{c: tables[c] for c, *_ in references}}
    values: dict[str, list] = {}
    place: dict[int, tuple[int, int]] = {}  # of a reference: the number of its parent key, its bit
    own_key: dict[str, int] = {}  # of a parent whose key is checked: the number of that key
    keys = 0
    for (parent, parent_column), own in members.items():
        kind = parents[parent].schema[parent_column].dataType
        if keyed.get(parent) == parent_column:
            own_key[parent] = keys
        for at in range(0, len(own), TAGS):
            values.setdefault(parent, []).append(_tagged(keys, 0, F.col(parent_column).cast("string")))
            for bit, i in enumerate(own[at:at + TAGS]):
                child, column = references[i][:2]
                text = F.col(column).cast("string")
                same = tables[child].schema[column].dataType == kind
                values.setdefault(child, []).append(_tagged(keys, 1 << bit, text if same else F.coalesce(F.col(column).try_cast(kind).cast("string"), text)))
                place[i] = keys, 1 << bit
            keys += 1
    tagged = reduce(DataFrame.unionByName, [
        frames[t].select(F.inline(F.array(*v))).filter(F.col("valor").isNotNull() | ((F.col("marca") == 0) & F.col("clave").isin(*own_key.values())))
        for t, v in values.items()])
    met = tagged.groupBy("clave", "valor").agg(F.bit_or("marca").alias("marcas"), F.count_if(F.col("marca") == 0).alias("filas"))
    # values of a kind are counted first, so that the checks are sums over a few rows
    kinds = met.groupBy("clave", F.when(F.col("filas") == 0, F.col("marcas")).alias("huerfano_de"), (F.col("filas") > 1).alias("repetido"),
                        F.col("valor").isNull().alias("nulo")).agg(F.count("*").alias("valores"), F.sum("filas").alias("filas"))

    def counted(key: int, condition: Column, what: str = "valores") -> Column:
        return F.coalesce(F.sum(F.when((F.col("clave") == key) & condition, F.col(what))), F.lit(0)).cast("bigint")

    rows = [(child, f"fk_{column}_to_{parent}_{parent_column}", "Integridad referencial Silver",
             counted(place[i][0], F.col("huerfano_de").bitwiseAND(place[i][1]) != 0))
            for i, (child, column, parent, parent_column) in enumerate(references)]
    for parent, key in own_key.items():
        twice, nulls, empty = _key_check_names([keyed[parent]])
        rows += [(parent, *twice, counted(key, F.col("repetido"))), (parent, *nulls, counted(key, F.col("nulo"), "filas")),
                 (parent, *empty, F.when(counted(key, F.col("huerfano_de").isNull()) == 0, 1).otherwise(0).cast("bigint"))]
    counts = kinds.agg(*[c.alias(f"_{i}") for i, (*_, c) in enumerate(rows)])
    results = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), F.lit("ERROR").alias("severity"),
                 F.col(f"_{i}").alias("failing_count"), F.lit(said).alias("description"))
        for i, (table, name, said, _) in enumerate(rows)])
    return counts.select(F.inline(results))


# types of which two values are equal exactly if their texts are
_TOLD_BY_TEXT = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType)


def checked_as_parents(references: Sequence[tuple[str, str, str, str]], tables: Mapping[str, DataFrame],
                       keys: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Tables whose key is one column that references look for: the grouping of references sees all its values."""
    found = {}
    for _, _, parent, column in references:
        if parent in tables and list(keys.get(parent, ())) == [column]:
            kind = tables[parent].schema[column].dataType
            if kind == T.StringType() or isinstance(kind, _TOLD_BY_TEXT):
                found[parent] = column
    return found


def _tagged(key: int, mark: int, value: Column) -> Column:
    return F.struct(F.lit(key).alias("clave"), F.lit(mark).cast("bigint").alias("marca"), value.alias("valor"))


def report(tables: Mapping[str, DataFrame], spark: SparkSession, *,
           keys: Mapping[str, Sequence[str]] = fv.PRIMARY_KEYS,
           references: Sequence[tuple[str, str, str, str]] = tuple(fv.FOREIGN_KEYS),
           identities: Sequence[tuple[str, str, str, float]] = tuple(fv.IDENTITIES),
           note_skipped: bool = True, shared: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All checks over a set of tables; parents of references come from them, else from ``shared``.

    Shared tables are only looked up, not checked again.  A reference with a missing side is reported as SKIPPED (or left out with
    ``note_skipped=False``), never silently passed.
    """
    if not tables:
        row = [(fv.NO_TABLES, "no_silver_tables", "INFO", 0, "No existen tablas Silver de negocio para validar")]
        return with_status(spark.createDataFrame(row, CHECK_SCHEMA))
    parts, skipped = [], []
    parents, found = {**(shared or {}), **tables}, []
    for child, column, parent, parent_column in references:
        if child in tables and parent in parents and column in tables[child].columns \
                and parent_column in parents[parent].columns:
            found.append((child, column, parent, parent_column))
        elif note_skipped and child in tables:
            skipped.append((child, f"fk_{column}_to_{parent}_{parent_column}", "INFO", None, "Tabla o columna ausente"))
    present = {name: [k for k in keys.get(name, ()) if k in tables[name].columns] for name in tables}
    keyed = checked_as_parents(found, tables, present)
    for name, df in tables.items():
        own = [(d, e, t) for table, d, e, t in identities if table == name]
        if present[name] and name not in keyed:
            parts.append(key_checks(name, df, present[name]))
        if own or not present[name]:
            parts.append(row_checks(name, df, (), own, emptiness=not present[name]))
    if found:
        parts.append(reference_checks(found, tables, parents, keyed))
    if skipped:
        parts.append(spark.createDataFrame(skipped, CHECK_SCHEMA))
    return with_status(reduce(DataFrame.unionByName, parts))


def with_status(checks: DataFrame) -> DataFrame:
    verdict = F.when(F.col("failing_count").isNull(), "SKIPPED").when(F.col("failing_count") == 0, "PASS")
    return checks.withColumn("status", verdict.otherwise("FAIL"))


def stamped(checks: DataFrame, environment: str, domain: str) -> DataFrame:
    """The stored form of a report: where and when it was made, worst first."""
    return checks.select(
        F.lit(environment).alias("environment"), F.lit(domain).alias("domain_name"), "table_name", "check_name",
        "severity", "failing_count", "status", "description", F.current_timestamp().alias("checked_at"))


def worst_first(checks: DataFrame) -> DataFrame:
    return checks.orderBy(F.desc("status"), "table_name", "check_name", "description")


def raise_on_errors(checks: DataFrame) -> None:
    """Optional gate: stop when any ERROR check failed (the report has one row per check)."""
    failed = checks.filter("severity = 'ERROR' and status = 'FAIL'").select("table_name", "check_name")
    if total := failed.count():
        shown = ", ".join(f"{r.table_name}.{r.check_name}" for r in failed.take(20))
        raise ValueError(f"{total} quality checks failed, such as {shown}")
