"""Lenient text-to-value coercion: text that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN_NUMBER = r"^\s*[+-]?[0-9]*(\.[0-9]*)?\s*$"


def _whole(c: Column, target: str) -> Column:
    plain = F.when(c.cast("string").rlike(_PLAIN_NUMBER), c.cast("string"))
    return plain.try_cast("decimal(38,4)").try_cast(target)


def to_int(c: Column) -> Column:
    """Text to int; a decimal part is cut off (``12.7`` gives 12)."""
    return _whole(c, "int")


def to_long(c: Column) -> Column:
    """Text to long; a decimal part is cut off."""
    return _whole(c, "bigint")


def to_dec(c: Column, precision: int, scale: int) -> Column:
    """Text to an exact decimal, so later sums do not depend on row order."""
    return c.try_cast(f"decimal({precision},{scale})")


def to_day(c: Column) -> Column:
    """Text to date."""
    return c.try_cast("date")
