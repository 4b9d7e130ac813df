"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _kind(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def _key(row):
    return tuple((_kind(v), "" if v is None else repr(v)) for v in row)


def compare(spark, con, build, statement: str, sf: str) -> str | None:
    """None when both give the same rows, else a description of the difference."""
    df = build(spark, sf)
    ours_columns = df.columns
    ours = [tuple(r) for r in df.collect()]
    theirs_cursor = con.execute(statement)
    theirs_columns = [d[0] for d in theirs_cursor.description]
    theirs = theirs_cursor.fetchall()
    if sorted(ours_columns) != sorted(theirs_columns):
        return f"columns differ: only ours {set(ours_columns) - set(theirs_columns)}, only SQL {set(theirs_columns) - set(ours_columns)}"
    order = sorted(ours_columns)
    left = [tuple(r[ours_columns.index(c)] for c in order) for r in ours]
    right = [tuple(r[theirs_columns.index(c)] for c in order) for r in theirs]
    if len(left) != len(right):
        return f"rows differ: ours {len(left)}, SQL {len(right)}"
    left.sort(key=_key)
    right.sort(key=_key)
    bad = [(a, b) for a, b in zip(left, right) if _key(a) != _key(b)]
    if bad:
        a, b = bad[0]
        diff = {c: (x, y) for c, x, y in zip(order, a, b) if _key((x,)) != _key((y,))}
        return f"{len(bad)} of {len(left)} rows differ, first: {diff} in {dict(zip(order, a))}"[:1500]
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as e

    sf = sys.argv[1]
    only = set(sys.argv[2:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    sqls = e.oracle_sql()
    for name, build in e.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        t = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, build, sqls[name], sf)
            else:
                problem = None if build(spark, sf).collect() is not None else "nothing"
                name += " (rows only)"
        except Exception as x:  # noqa: BLE001
            problem = f"{type(x).__name__}: {str(x)[:1500]}"
        bad += problem is not None
        print(f"{'OK  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
