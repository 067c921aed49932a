"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, scale: int = 2) -> Column:
    """Round a double half-up at ``scale`` decimals, returned as double.

    Goes through a 6-place decimal first so that the last-bit noise of a
    floating average cannot move a value across a rounding boundary; the
    result is identical in any engine that casts decimals half-up. The price: a
    value within 5e-7 below a boundary rounds up (2.4949996 gives 2.50), where
    rounding once gives 2.49. That is the tolerance of every rounded column.
    """
    return c.cast("decimal(38,6)").cast(f"decimal(38,{scale})").cast("double")


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true (NULL counts as false)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """``round(100 * part / whole, scale)``, NULL when ``whole`` is 0."""
    return F.when(whole > 0, round_half_up(F.lit(100.0) * part / whole, scale))
