"""Connected components of a graph as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.workspace import stage


def components(edges: DataFrame) -> DataFrame:
    """Nodes of the edges (``a``, ``b``: long) with the smallest node they reach: ``node``, ``component``.

    Alternates large-star and small-star steps: every node hangs its larger (then its smaller) neighbours on the
    smallest one it knows, until nothing changes; a few rounds even for long chains.  A node's smallest neighbour is
    a combinable minimum joined back, so a node with very many neighbours is never gathered in one task.  Each round
    is written to the shared folder, which cuts the lineage.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("b", "a"))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = stage(small.filter("a <> b").distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    told = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return told.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Number and fingerprint of the edges; equal for equal sets."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
