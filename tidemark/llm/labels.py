"""Labelled samples of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: str, folds: int) -> Column:
    """Which of ``folds`` parts a document belongs to; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def labelled_sample(labels: DataFrame, mark: str, training: Column, limit: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``limit`` labelled ids (``_id``, ``_mark``) of the training folds; an id with several labels has the largest."""
    known = labels.filter(training).select(F.col(doc_id).alias("_id"), F.col(mark).cast("int").alias("_mark")).dropna()
    return known.groupBy("_id").agg(F.max("_mark").alias("_mark")).orderBy(F.xxhash64("_id"), "_id").limit(limit)
