"""The letters by which byte-level vocabularies spell bytes."""

from __future__ import annotations


def byte_letters() -> dict[str, int]:
    """Printable Latin-1 characters stand for themselves, the other bytes for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}
