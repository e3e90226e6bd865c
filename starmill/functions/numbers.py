"""Number coercion (C5, C6, C10) and ratios on decimals (F4, F5, marts)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

MONEY = T.DecimalType(18, 2)
RATIO = T.DecimalType(18, 6)
TOTAL = T.DecimalType(38, 2)

# What counts as a number: ASCII digits, optional sign, point and exponent. Spark's own casts
# also take other scripts' digits and control characters, which the source system rejects.
NUMBER = r"^[ \t\n\x0B\f\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\x0B\f\r]*$"


def is_number(col: Column) -> Column:
    return col.rlike(NUMBER)


def to_num(col: Column, dtype: T.DecimalType) -> Column:
    """Text to a decimal rounded half up to the column's scale; NULL if it is no number or does not fit."""
    return F.when(is_number(col), col.try_cast(dtype))


def overflows(col: Column, value: Column) -> Column:
    """True where ``value``, read from the text ``col``, is NULL only because the number is too large (K5)."""
    return value.isNull() & is_number(col) & (F.abs(col.try_cast("double")) < float("inf"))


def to_order_id(col: Column) -> Column:
    """Text to a 64-bit key, cutting fractions (12.7 -> 12). The decimal hop keeps large ids exact."""
    return to_num(col, T.DecimalType(38, 18)).try_cast("bigint")


def total(col: Column | str) -> Column:
    """Exact sum, wide enough for any table size."""
    return F.sum(col).cast(TOTAL)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient at six digits, NULL for a zero or missing denominator.

    Operands wider than NUMERIC(18) are brought to 38 digits first: Spark then divides straight
    to six digits and rounds once instead of twice.
    """
    return F.try_divide(numerator, denominator).try_cast(RATIO)
