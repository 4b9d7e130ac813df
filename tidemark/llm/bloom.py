"""A blocked Bloom filter of bounded size, made and probed by DataFrame functions.

A listed value sets one bit in each of the eight 64-bit words of one block; Spark ORs the blocks together.  The number
of blocks follows the list up to ``MOST_BLOCKS`` (8 MB, so it may be broadcast); with a longer list more values pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.batches import unused_name

MOST_BLOCKS = 1 << 17
VALUES_A_BLOCK = 32  # 16 bits a value
WORDS = 8


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks))


def _mask(value: Column, word: int) -> Column:
    place = F.shiftright(F.xxhash64(F.lit(1), value), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_filter(listed: DataFrame, column: str, blocks: int) -> DataFrame:
    """The used blocks: ``_block`` and eight words; at most ``blocks`` rows of nine longs."""
    value = F.col(f"`{column}`")
    masked = listed.select(_block(value, blocks).alias("_block"), *[_mask(value, k).alias(f"_w{k}") for k in range(WORDS)])
    return masked.groupBy("_block").agg(*[F.bit_or(f"_w{k}").alias(f"_w{k}") for k in range(WORDS)])


def with_flag(df: DataFrame, column: str, listed: DataFrame, listed_column: str, flag: str, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The frame with a boolean ``flag``: false only where the column's value is not listed."""
    blocks = max(1, min(most_blocks, -(-listed.count() // VALUES_A_BLOCK)))
    names = {c: unused_name(df, c) for c in ("_block", *[f"_w{k}" for k in range(WORDS)])}
    # bounded by most_blocks, whatever the list
    words = F.broadcast(bloom_filter(listed, listed_column, blocks).select(*[F.col(c).alias(own) for c, own in names.items()]))
    value = F.col(f"`{column}`")
    keyed = df.withColumn(names["_block"], _block(value, blocks)).join(words, names["_block"], "left")
    held = reduce(lambda a, b: a & b, [F.col(names[f"_w{k}"]).bitwiseAND(_mask(value, k)) == _mask(value, k) for k in range(WORDS)])
    return keyed.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(held, F.lit(False)).alias(flag))
