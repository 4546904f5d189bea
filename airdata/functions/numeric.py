"""Numeric helpers shared by the analytics operators.

Rounding: PostgreSQL ``ROUND(numeric, n)`` rounds half away from zero on the
exact decimal value. Rounding a double directly differs between engines at
ties (1.005), so values are rounded through ``decimal(38,10)`` and returned as
double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(col: Column, digits: int = 2) -> Column:
    return F.round(col.cast("decimal(38,10)"), digits).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)`` as double (null on a zero denominator)."""
    return num.cast("double") / F.when(den != 0, den.cast("double"))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), digits)``."""
    return round_half_up(ratio(num * 100, den), digits)


def count_if(cond: Column) -> Column:
    """``COUNT(*) FILTER (WHERE cond)`` as bigint."""
    return F.count(F.when(cond, F.lit(1)))


def to_double(col: Column) -> Column:
    return col.cast("double")
