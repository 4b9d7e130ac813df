"""Paths as users write them, as readers take them and as scans give them back."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def plain(path: Column) -> Column:
    """A path or file name as users and listings write it; scans give it URI-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal(path: str) -> str:
    """A path for a reader, which would take some characters of a file's name for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)
