"""Arrow batches of texts: bounded blocks, words and shingles as 64-bit hashes.

A word is a run of bytes other than the six ASCII white-space characters, A-Z lower-cased.  Its hash
is a polynomial over a random value per byte, finished by a bit mixer; a shingle's hash combines the
hashes of its words.  Everything is numpy over the bytes of a block, so no Python object per word exists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BYTES = 1 << 20
SHINGLE = 5

_random = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64)
SPACES = b" \t\n\x0b\x0c\r"
_BYTE[list(SPACES)] = 0
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)  # undoes a step, so that a word's hash does not depend on where it stands
_PLACE = _random.integers(1, 2**64, SHINGLE, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_tables: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """Powers of ``base`` modulo 2^64, at least n of them; kept for the next block."""
    if len(_tables.get(base, ())) < n:
        steps = np.full(1 << max(12, n.bit_length()), base, dtype=np.uint64)
        steps[0] = 1
        _tables[base] = np.multiply.accumulate(steps)
    return _tables[base]


def _block_words(data: np.ndarray) -> np.ndarray:
    value = _BYTE[data]
    inside = value != 0
    if not inside.any():
        return np.empty(0, dtype=np.uint64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside > before)
    sums = np.add.reduceat(value * _powers(len(data), _STEP)[:len(data)], starts)
    return mix(sums * _powers(len(data), _BACK)[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of every word of a text, in order; texts over BLOCK_BYTES are cut at white space."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    if len(data) <= BLOCK_BYTES:
        return _block_words(data) if len(data) else np.empty(0, dtype=np.uint64)
    parts, at = [], 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data) and data[end] not in SPACES:
            end += 1
        parts.append(_block_words(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of all windows of ``size`` words; of the whole sequence if it is shorter."""
    if len(words) == 0:
        return words
    windows = len(words) - size + 1
    if windows < 1:
        return mix(np.array([(words * _PLACE[:len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))], dtype=np.uint64))
    total = words[:windows] * _PLACE[0]
    for k in range(1, size):
        total = total + words[k:windows + k] * _PLACE[k]
    return np.unique(mix(total))


def shingle_set(text: str | None) -> np.ndarray:
    return shingle_hashes(word_hashes(text))


ROWS_KEY, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def in_batches(df: DataFrame) -> DataFrame:
    """The frame; its session hands texts to Python in batches of 1,000 rows, unless it has a setting of its own.

    Spark's 10,000 rows of text are tens of megabytes outside the heap for every task and every Python step in it.
    """
    if df.sparkSession.conf.get(ROWS_KEY, None) is None:
        df.sparkSession.conf.set(ROWS_KEY, ROWS)
    return df


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in smaller ones, so that what a function derives from texts stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def unused_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores until no column of the frame has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
