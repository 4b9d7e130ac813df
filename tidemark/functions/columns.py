"""Scalar column rules shared by every layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import fixed_values as fv

MONTH_PATTERN = r"^(\d{4}-\d{2})"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator as double; NULL when the denominator is NULL or zero.

    Sums of money stay exact decimals up to this point, so the only rounding is
    the final double division.
    """
    bottom = F.nullif(col(denominator).cast("double"), F.lit(0.0))
    return col(numerator).cast("double") / bottom


def mean(c: str | Column) -> Column:
    """Average as exact sum over count (the result does not depend on row order)."""
    return ratio(F.sum(col(c)), F.count(col(c)))


def clean_text(c: str | Column) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def flag(c: str | Column) -> Column:
    """Boolean from the spellings people type; anything unknown is NULL."""
    word = F.lower(F.trim(col(c).cast("string")))
    return F.when(word.isin(fv.TRUE_WORDS), True).when(word.isin(fv.FALSE_WORDS), False)


def whole_number(c: str | Column) -> Column:
    """bigint from text, numbers such as '12.0' included, without their fraction; NULL when it is not a number.

    The way over decimal reads both spellings at once: a failed text-to-bigint cast
    raises and catches an exception per row, which is far slower than a good cast.  Up
    to 18 digits and nothing else, as most keys and counts are, need no decimal.
    """
    return F.when(_only_digits(c), col(c).cast("string").try_cast("bigint")).otherwise(exact_number(c).try_cast("bigint"))


def _only_digits(c: str | Column) -> Column:
    shown = F.trim(col(c).cast("string"))
    return F.length(shown).between(1, 18) & (F.translate(shown, "0123456789", "") == "")


def exact_number(c: str | Column) -> Column:
    """A number with up to 18 decimals; further ones are cut off, so that narrowing never rounds up."""
    shown = F.trim(col(c).cast("string"))
    # a point and 19 decimals are 20 characters
    return F.when(F.length(shown) < 20, shown).otherwise(F.regexp_replace(shown, r"(\.\d{18})\d+", "$1")).try_cast("decimal(38,18)")


def loses_fraction(c: str | Column) -> Column:
    """Is it a number that is not whole?"""
    return F.when(_only_digits(c), False).otherwise(F.coalesce(exact_number(c) % 1 != 0, F.lit(False)))


def month_key(c: str | Column) -> Column:
    """Leading yyyy-MM of a text, else NULL."""
    return F.nullif(F.regexp_extract(F.trim(col(c).cast("string")), MONTH_PATTERN, 1), F.lit(""))


def month_of_row(columns: list[str]) -> Column:
    """A row's month: its own month key, else the year and month of its source folder.

    Rows of a full (month-less) load without a month of their own stay NULL.
    """
    candidates = []
    if fv.MONTH in columns:
        candidates.append(F.col(fv.MONTH))
    if fv.SOURCE_YEAR in columns and fv.SOURCE_MONTH in columns:
        candidates.append(month_key(F.concat(F.col(fv.SOURCE_YEAR), F.lit("-"), F.col(fv.SOURCE_MONTH))))
    if not candidates:
        raise ValueError(f"no month in {columns}")
    return F.coalesce(*candidates)


def in_month(c: str | Column, expected: str | Column) -> Column:
    """Does a month text such as '2026-01', '2026-01-01' or ' 2026-01 ' mean the month expected?

    '202601' and '2026-0101' do not: the seventh character must end the month.
    """
    text = F.trim(col(c).cast("string"))
    wanted = F.lit(expected) if isinstance(expected, str) else expected
    return text.startswith(wanted) & ~F.substring(text, 8, 1).rlike("[0-9]")


def domain_code(c: str | Column) -> Column:
    """Code for a label: runs of other characters become '_', ends trimmed, lower case."""
    joined = F.regexp_replace(F.trim(col(c)), "[^A-Za-z0-9]+", "_")
    return F.lower(F.regexp_replace(joined, "^_|_$", ""))


def allowed_or_null(c: str | Column, values) -> Column:
    return col(c).isNull() | col(c).isin(list(values))


def record_hash(columns: list[str]) -> Column:
    """SHA-256 of a row.

    The row is serialised as JSON with its NULLs, so neither separators inside
    values nor the difference between NULL and text can make two rows collide.
    """
    parts = [F.col(f"`{c}`").cast("string").alias(c) for c in columns]
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def typed(name: str, current: T.DataType) -> Column:
    """A column cast by its name; the first rule that knows the name wins."""
    c = F.col(f"`{name}`")
    if name in fv.DATES:
        out = c if isinstance(current, T.DateType) else c.try_cast("date")
    elif name in fv.FLAGS:
        out = flag(c)
    elif name in fv.MONEY:
        out = c.try_cast("decimal(18,2)")
    elif name in fv.RATES:
        out = c.try_cast("decimal(10,4)")
    elif name in fv.WHOLE_NUMBERS:
        out = c if isinstance(current, T.LongType) else whole_number(c)
    elif name in fv.REALS:
        out = c.try_cast("double")
    elif name.endswith("_id") or name in fv.ALWAYS_TEXT:
        out = c.cast("string")
    elif name == fv.MONTH:
        out = month_key(c)
    else:
        out = c
    return out.alias(name)


def text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def packed_hash(c: str) -> Column:
    """The 32 bytes that the 64 characters of a record hash spell; NULL for a text that is no such spelling."""
    spelt = F.unhex(F.col(f"`{c}`"))
    return F.when(F.lower(F.hex(spelt)) == F.col(f"`{c}`"), spelt)


def loose_hash(c: str) -> Column:
    """What ``packed_hash`` does not keep."""
    return F.when(packed_hash(c).isNull(), F.col(f"`{c}`"))
