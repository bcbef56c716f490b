"""Lenient parsing of raw string columns: bad values become null, nothing raises under ANSI mode."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens a raw file uses for "missing" (besides the empty field).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

WHITESPACE = " \t\n\r\x0b\x0c"


def null_if_na(col: Column) -> Column:
    return F.when(~col.isin(*NA_TOKENS), col)


def is_blank(col: Column) -> Column:
    """True for null and for whitespace-only text; never null."""
    return F.coalesce(F.btrim(col.cast("string"), F.lit(WHITESPACE)) == "", F.lit(True))


def to_money(col: Column, precision: int = 28, scale: int = 6) -> Column:
    """Text to exact decimal; null where it is not a number."""
    return col.cast("string").try_cast(f"decimal({precision},{scale})")


def to_date(col: Column) -> Column:
    """Calendar date in year-month-day order, padded or not; null for anything else (2024-02-30, 2024-02)."""
    return F.try_to_date(col.cast("string"), "yyyy-M-d")


def month_of(date_col: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(date_col, "MM")


def all_present(*names: str) -> Column:
    """True where none of the columns is null. `dropna` says the same of texts, but as one test of all columns that is made even of a
    column that is never null, deep in the plan, where it repeats all that the column is made of."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def is_true(predicate: Column) -> Column:
    """A null comparison counts as false."""
    return F.coalesce(predicate, F.lit(False))
