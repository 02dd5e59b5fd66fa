"""Casts, conditionals and NULL handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_double(c: Column, lenient: bool = False) -> Column:
    """Text to double; bad text raises, or is NULL when ``lenient``."""
    return c.try_cast("double") if lenient else c.cast("double")


def parse_int(c: Column, lenient: bool = False) -> Column:
    """Digits to integer; bad text raises, or is NULL when ``lenient``."""
    return c.cast("string").try_cast("int") if lenient else c.cast("string").cast("int")


def value_of(c: Column) -> Column:
    return c.cast("string")


def to_number(c: Column) -> Column:
    return c.cast("double")


def literal(value) -> Column:
    """A constant; an empty expression or ``None`` is NULL."""
    return F.lit(None) if value is None or value == "" else F.lit(value)


def ternary(condition: Column, yes, no) -> Column:
    """``condition ? yes : no``; nests to any depth."""
    return F.when(condition, yes).otherwise(no)


def all_of(*conditions: Column) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


def any_of(*conditions: Column) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out


def negated(condition: Column) -> Column:
    return ~condition


def is_null(c: Column) -> Column:
    return c.isNull()


def not_null(c: Column) -> Column:
    return c.isNotNull()


def null_if(c: Column, value) -> Column:
    return F.nullif(c, F.lit(value))


def nvl(c: Column, other) -> Column:
    return F.coalesce(c, other if isinstance(other, Column) else F.lit(other))


def is_in(c: Column, *values) -> Column:
    return c.isin(*values)
