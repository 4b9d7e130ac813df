"""Table contracts: columns and types of a table, its key, and what its key resolves to."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark import fixed_values as fv


@dataclass(frozen=True)
class TableContract:
    """What one landed table must look like. Types are 'string', 'bigint' or 'double'."""

    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def struct(self) -> T.StructType:
        kinds = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType()}
        return T.StructType([T.StructField(n, kinds[t], True) for n, t in self.columns])

    def text_struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType(), True) for n in self.column_names])

    def missing(self, found: Iterable[str]) -> list[str]:
        """Contract columns a batch lacks; columns beyond the contract are fine."""
        present = set(found)
        return [c for c in self.column_names if c not in present]


DICTIONARY = TableContract(
    "data_dictionary",
    (("tabla", "string"), ("campo", "string"), ("tipo_dato_csv", "string"), ("rol", "string")),
    ("tabla", "campo"),
)


def dictionary_rows(dictionary: DataFrame, position: str = "posicion") -> DataFrame:
    """The dictionary as one row per column: Spark type, place in the table, key or not."""
    declared = F.trim(F.col("tipo_dato_csv"))
    kinds = F.when(declared == "int64", "bigint").when(declared == "float64", "double").otherwise("string")
    return dictionary.select(
        F.trim("tabla").alias("tabla"),
        F.trim("campo").alias("campo"),
        F.col(position).alias("posicion"),
        kinds.alias("tipo"),
        F.coalesce(F.upper(F.trim("rol")) == "PK", F.lit(False)).alias("es_clave"),
    )


def dictionary_summary(rows: DataFrame) -> DataFrame:
    """Columns, key columns and types per table, with combinable aggregates only."""
    return rows.groupBy("tabla").agg(
        F.count("*").alias("columnas"),
        F.count_if("es_clave").alias("columnas_clave"),
        F.min_by(F.when(F.col("es_clave"), F.col("campo")),
                 F.when(F.col("es_clave"), F.col("posicion"))).alias("primera_clave"),
        F.count_if(F.col("tipo") == "bigint").alias("enteros"),
        F.count_if(F.col("tipo") == "double").alias("reales"),
        F.count_if(F.col("tipo") == "string").alias("textos"),
    )


def contracts_from(rows: DataFrame) -> dict[str, TableContract]:
    """Contracts on the driver: a dictionary has one row per *column*, never per data row."""
    by_table: dict[str, list] = {}
    for r in rows.orderBy("tabla", "posicion").toLocalIterator():
        by_table.setdefault(r.tabla, []).append(r)
    return {
        name: TableContract(name, tuple((r.campo, r.tipo) for r in found),
                            tuple(r.campo for r in found if r.es_clave))
        for name, found in by_table.items()
    }


def is_known(table: str, contracts: dict[str, TableContract]) -> bool:
    return table in contracts or table in fv.TABLES_WITHOUT_DICTIONARY


def merge_keys(table: str, columns: Iterable[str], contract: TableContract | None = None) -> list[str]:
    """Key of an upsert: the contract's key, else the table's fixed key, else the record hash.

    A key counts only if the frame has all of its columns.  Where a row came from is never
    a key: a file has many rows.
    """
    have = set(columns)
    for choice in (contract.key if contract else (), fv.PRIMARY_KEYS.get(table, ())):
        if choice and have.issuperset(choice):
            return list(choice)
    return [fv.RECORD_HASH]
