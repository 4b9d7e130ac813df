"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is found in a document if the document has at least ``SHARE`` of the item's distinct word shingles.
Documents are far longer than items, so the similarity of the two sets says little; what is searched is containment.
Items are partitioned by size (powers of two).  Every partition has its own signature length k: an item's signature
are its k smallest shingle hashes (a bottom-k MinHash), with k = n - ceil(SHARE * n) + 1 for the largest n of the
partition, so that a document without any of them lacks more than the item may lack: no find is lost.  A document
probes the signatures with its hashes; items of partitions that need more shingles than the document has are left
out.  What remains is verified by the exact share of the item's shingles, compared as words.

Items travel to the executors in slices of at most ``SLICE_BYTES``, as many as the benchmark needs; documents are read
once a slice and never shuffled, so neither a passage in a third of the documents nor a long document is special.

Words are runs of anything but ASCII white space, A-Z lower-cased; a text of fewer than five words is one shingle.
Null and empty items are found nowhere, null and empty documents hold nothing.  Items with the same id are different
items; a document or item that is repeated gives repeated rows.  Further columns of documents pass through.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.batches import SHINGLE, in_batches, shingle_hashes, shingle_set, slices, word_hashes

SHARE = (3, 4)  # at least three quarters
SLICE_BYTES = 32 << 20
WORD = re.compile("[^\x20\x09-\x0D]+")  # fixed value
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

FOUND = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("n_shared", T.LongType()),
                                  T.StructField("n_item", T.LongType())]))


def shingles(text: str | None) -> set[str]:
    """The distinct shingles of a text as words joined by a space."""
    words = WORD.findall((text or "").translate(LOWER))
    return {" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def least_shared(n: int) -> int:
    return -(-SHARE[0] * n // SHARE[1])


class Items:
    """The items of a slice: their shingles, and their signatures by size partition."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids, self.sets = [], []
        sizes, signatures = [], []
        for item_id, text in rows:
            own = shingles(text)
            if own:
                hashes = shingle_set(text)
                largest = (1 << int(len(own)).bit_length()) - 1
                k = min(len(own), largest - least_shared(largest) + 1)
                self.ids.append(item_id)
                self.sets.append(own)
                sizes.append(len(own))
                signatures.append(hashes[:k])
        self.partition = np.array([int(n).bit_length() for n in sizes], dtype=np.int64)
        owner = np.repeat(np.arange(len(signatures)), [len(x) for x in signatures])
        values = np.concatenate(signatures) if signatures else np.empty(0, dtype=np.uint64)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[self.values >> np.uint64(44)] = True

    def probe(self, hashes: np.ndarray) -> list[int]:
        """Items with a signature value among the hashes and small enough to be in the document."""
        hashes = hashes[self.filter[hashes >> np.uint64(44)]]
        if len(hashes) == 0:
            return []
        begin, end = np.searchsorted(self.values, hashes, "left"), np.searchsorted(self.values, hashes, "right")
        hit = np.flatnonzero(end > begin)
        return sorted({int(o) for i in hit for o in self.owner[begin[i]:end[i]]})

    def find(self, text: str | None) -> list[dict]:
        words = word_hashes(text)
        hashes = shingle_hashes(words)
        candidates = [i for i in self.probe(hashes) if least_shared(1 << int(self.partition[i] - 1)) <= len(hashes)]
        if not candidates:
            return []
        own = shingles(text)
        shared = [(i, len(self.sets[i] & own)) for i in candidates]
        return [{"item_id": self.ids[i], "n_shared": n, "n_item": len(self.sets[i])} for i, n in shared if n >= least_shared(len(self.sets[i]))]


def item_slices(items: DataFrame, item_id: str, text: str, slice_bytes: int) -> list[DataFrame]:
    """The items cut by a hash so that each part's texts take about ``slice_bytes`` at most; one part where all fit."""
    picked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).filter("text is not null")
    size = picked.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-2 * size // slice_bytes)) if size > slice_bytes else 1
    return [picked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) for k in range(parts)]


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", found: str = "found_items", item_id: str = "item_id",
               item_text: str = "text", keep_text: bool = True, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The documents with an array column ``found`` of the items they hold (an existing column of that name is replaced)."""
    parts = item_slices(items, item_id, item_text, slice_bytes)
    base = docs.drop(found)
    names = [found if k == 0 else f"_{found}_{k}" for k in range(len(parts))]
    out = reduce(lambda df, p: _find_slice(df, p[1], text, p[0], keep_text or p[0] != names[-1]), zip(names, parts), base)
    if len(parts) > 1:
        out = out.withColumn(found, F.concat(*names)).drop(*names[1:])
    return out


def _find_slice(docs: DataFrame, items: DataFrame, text: str, found: str, keep_text: bool) -> DataFrame:
    rows = [(r["item_id"], r["text"]) for r in items.toLocalIterator()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    at = docs.columns.index(text)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    picked = [docs.columns.index(f.name) for f in kept]
    schema = T.StructType([*kept, T.StructField(found, FOUND)])
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_item", pa.int64())]))

    def run(batches):
        index = Items(shared.value)
        for batch in batches:
            for part in slices(batch):
                hits = pa.array([index.find(x) for x in part.column(at).to_pylist()], type=arrow)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in picked], hits], [f.name for f in schema.fields])

    return in_batches(docs).mapInArrow(run, schema)


def without_items(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item, with their own columns."""
    return find_items(docs, items, text, "_found_items").filter(F.size("_found_items") == 0).drop("_found_items")
