"""Merges as DataFrame algebra (no table format needed)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def batch_keys(batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The batch's keys, renamed, and the condition that a row on the other side has one of them.

    The comparison is null-safe: NULL keys match each other.
    """
    renamed = batch.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)])
    matches = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return renamed, reduce(lambda a, b: a & b, matches)


def not_in_batch(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the batch does not carry."""
    incoming, same_key = batch_keys(batch, keys)
    return target.join(incoming, same_key, "left_anti")


def in_batch(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the batch carries."""
    incoming, same_key = batch_keys(batch, keys)
    return target.join(incoming, same_key, "left_semi")


def keyed_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch replace rows of the same key, all others are kept or added.

    Columns only one side has are filled with typed NULLs, so an updated row
    loses derived columns its batch does not bring and a new column is NULL in
    old rows.  The batch must have one row per key (see ``latest_by_key``).
    """
    return not_in_batch(target, batch, keys).unionByName(batch, allowMissingColumns=True)


def update_only(target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` in target rows that have an update; other updates are ignored."""
    incoming = updates.select(
        F.col(key).alias("_key"), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    joined = target.join(incoming, F.col(key) == F.col("_key"), "left")
    changed = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in target.columns])
