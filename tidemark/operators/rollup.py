"""Monthly rollups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as fv
from tidemark.functions.columns import month_of_row, ratio


class Lake(Mapping):
    """Silver tables by name.

    Values may be frames or functions that build one when first asked for.
    ``keyed`` names the tables whose primary key is known to be unique (they were
    written by a keyed upsert): there ``count`` replaces the far costlier
    ``count(distinct)``.  ``rolled`` holds published products by name: sums over a coarser
    grain are taken from them instead of the facts, where that is exact.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], keyed: Iterable[str] = ()):
        self._tables = dict(tables)
        self.keyed = frozenset(keyed)
        self.rolled: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        found = self._tables[name]
        if callable(found) and not isinstance(found, DataFrame):
            found = self._tables[name] = found()
        return found

    def __iter__(self):
        return iter(self._tables)

    def __len__(self):
        return len(self._tables)

    def rows_of(self, table: str, only: Column | None = None) -> Column:
        """Number of distinct keys of a one-column-key table, optionally of those rows only."""
        (key,) = fv.PRIMARY_KEYS[table]
        ids = F.col(key) if only is None else F.when(only, F.col(key))
        return F.count(ids) if table in self.keyed else F.count_distinct(ids)


def total(c: str) -> Column:
    return F.sum(c)


def hits(condition: str | Column) -> Column:
    """Rows where the condition is true; NULL counts as not."""
    return F.count_if(F.col(condition) if isinstance(condition, str) else condition)


def by_month(facts: DataFrame) -> DataFrame:
    """Facts with the month they count for."""
    dated = facts.withColumn("_mes", month_of_row(facts.columns))
    if fv.MONTH in dated.columns:
        dated = dated.drop(fv.MONTH)
    return dated.withColumnRenamed("_mes", fv.MONTH)


def monthly(facts: DataFrame, *grain: str, dealt: Sequence[str] = (), **measures: Column) -> DataFrame:
    """Group facts by month and ``grain``.

    Every measure has a partial form, so a group holding a third of all rows
    costs one row per map task after the first stage.  Where groups are nearly as many as
    rows, sums are wider than the rows they are of and nothing is combined: rows are then ``dealt`` by some
    columns of the grain before they are grouped, and what groups or joins by these afterwards needs no further shuffle.
    """
    dated = by_month(facts)
    if dealt:
        dated = dated.repartition(*dealt)
    return dated.groupBy(fv.MONTH, *grain).agg(*[c.alias(name) for name, c in measures.items()])


def summed(lake: Lake, fact: str, product: str, *grain: str, dealt: Sequence[str] = (), **measures: tuple[str, Column]) -> DataFrame:
    """Measures of a fact by month and ``grain``: from the published product if its rows add up to them.

    A measure is named by its column in the product and by what it is over the fact, which is ``dealt`` as ``monthly``
    does it.  Counts of rows add up only where the fact's key is unique.
    """
    if product in lake.rolled and fact in lake.keyed:
        return lake.rolled[product].groupBy(fv.MONTH, *grain).agg(*[F.sum(c).alias(name) for name, (c, _) in measures.items()])
    return monthly(lake[fact], *grain, dealt=dealt, **{name: over_fact for name, (_, over_fact) in measures.items()})


def with_ratios(df: DataFrame, **pairs: tuple[str, str]) -> DataFrame:
    return df.withColumns({name: ratio(top, bottom) for name, (top, bottom) in pairs.items()})
