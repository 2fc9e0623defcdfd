"""Number conversions with two's-complement and saturating semantics.

ANSI casts raise on NaN and overflow; the record formats expect a truncating cast that maps NaN
to 0 and saturates, and integer arithmetic that wraps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def _clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def to_int_saturating(value: Column) -> Column:
    """Double to int: truncate towards zero, NaN becomes 0, out of range saturates."""
    # least and greatest skip nulls
    number = _clamp(F.nanvl(value, F.lit(0.0)), float(_INT_MIN), float(_INT_MAX))
    return F.when(value.isNotNull(), number.cast("int"))


def floor_to_int(value: Column) -> Column:
    """The same of the floor of a double."""
    # beyond 4e9 the result saturates anyway, and floor() gives a bigint
    number = F.floor(_clamp(F.nanvl(value, F.lit(0.0)), -4e9, 4e9))
    return F.when(value.isNotNull(), _clamp(number, _INT_MIN, _INT_MAX).cast("int"))


def _wrap(value: Column, bits: int, sql_type: str) -> Column:
    half = F.lit(2 ** (bits - 1)).cast("bigint")
    return (F.pmod(value + half, F.lit(2**bits).cast("bigint")) - half).cast(sql_type)


def wrap_int(value: Column) -> Column:
    """Bigint to int, keeping the low 32 bits."""
    return _wrap(value, 32, "int")


def wrap_byte(value: Column) -> Column:
    """Bigint to tinyint, keeping the low 8 bits."""
    return _wrap(value, 8, "tinyint")


def parse_integer(token: Column, sql_type: str) -> Column:
    """Strict decimal integer (no blanks, no fraction); null when malformed or out of range.

    The cast is as strict, but for blanks around the number: a sign or digit has to come first (they
    lie between "+" and "9") and a digit last.
    """
    first, last = F.left(token, F.lit(1)), F.right(token, F.lit(1))
    return F.when(first.between("+", "9") & last.between("0", "9"), token.try_cast(sql_type))


def parse_float(token: Column) -> Column:
    """Float text; empty means 0.0, anything else unreadable gives null.

    Spark reads a few case-insensitive spellings ("inf", "nan") that the formats reject.
    """
    number = token.try_cast("float")
    unusual = F.isnan(number) | number.isin(float("inf"), float("-inf"))
    spelled = token.rlike("[0-9]|NaN|Infinity")
    return (
        F.when(unusual, F.when(spelled, number))
        .when(token == "", F.lit(0.0).cast("float"))
        .otherwise(number)
    )
