"""Compressed numbers in binary columns: arrays of unsigned 64-bit numbers by byte planes in one zstd frame."""

from __future__ import annotations

import numpy as np
import zstandard

_pack = zstandard.ZstdCompressor(level=1)
_unpack = zstandard.ZstdDecompressor()


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 to 2^64 - 1; high planes of zeros cost nearly nothing."""
    parts = [np.array([len(arrays), *[len(a) for a in arrays]], dtype="<u8").tobytes()]
    for a in arrays:
        planes = np.ascontiguousarray(a, dtype="<u8").view(np.uint8).reshape(-1, 8).T
        used = 8
        while used and not planes[used - 1].any():
            used -= 1
        parts += [bytes([used]), planes[:used].tobytes()]
    return _pack.compress(b"".join(parts))


def expand(blob: bytes) -> list[np.ndarray]:
    raw = memoryview(_unpack.decompress(blob))
    count = int(np.frombuffer(raw[:8], dtype="<u8")[0])
    lengths = np.frombuffer(raw[8:8 + 8 * count], dtype="<u8").tolist()
    at, arrays = 8 + 8 * count, []
    for n in lengths:
        used = raw[at]
        planes = np.zeros((8, n), dtype=np.uint8)
        planes[:used] = np.frombuffer(raw[at + 1:at + 1 + used * n], dtype=np.uint8).reshape(used, n)
        arrays.append(np.ascontiguousarray(planes.T).view("<u8").reshape(n))
        at += 1 + used * n
    return arrays
