"""Words of byte strings as numpy arrays: 64-bit hashes, begins and ends, without a Python object per word.

A word is a run of bytes that its table gives a value; A-Z count as a-z.  Two different words share a hash with a
probability of 2^-64.
"""

from __future__ import annotations

import re

import numpy as np

from tidemark.llm.batches import _BACK, _STEP, BLOCK_BYTES, _powers, mix

_SEED = 20240612


def table(separators: bytes) -> np.ndarray:
    """A value for each byte, none for separators.

    The separators alone decide the values: Python workers import the modules that ask for tables in any order, and
    all of them must give a word the same hash.
    """
    values = np.random.Generator(np.random.PCG64([_SEED, *separators])).integers(1, 2**64, 256, dtype=np.uint64)
    values[list(separators)] = 0
    values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


def _block(data: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    value = values[data]
    edges = np.diff((value != 0).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts, ends
    sums = np.add.reduceat(value * _powers(len(data), _STEP)[:len(data)], starts)
    return mix(sums * _powers(len(data), _BACK)[starts]), starts, ends


def words(raw: bytes, values: np.ndarray, separator: re.Pattern) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin and end of every word, in order; done in blocks that are cut at a ``separator``."""
    data, parts, at = np.frombuffer(raw, dtype=np.uint8), [], 0
    while at < len(raw):
        cut = separator.search(raw, at + BLOCK_BYTES)
        stop = cut.end() if cut else len(raw)
        hashes, starts, ends = _block(data[at:stop], values)
        parts.append((hashes, starts + at, ends + at))
        at = stop
    if not parts:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(column) for column in zip(*parts))
