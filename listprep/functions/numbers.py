"""Exact percentages and display forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_2dp(diff: Column, base: Column) -> Column:
    """``diff / base * 100`` to two decimals, half away from zero; NULL when the base is 0.

    Whole numbers on purpose: binary floats round 1.005 differently from engine to engine.  As decimals of 24
    digits, so that no difference of two bigints overflows.
    """
    wide = lambda c: c.cast("decimal(24,0)")
    base = wide(base)
    twice = F.nullif(base * F.lit(2).cast("decimal(1,0)"), F.lit(0).cast("decimal(25,0)"))
    whole = F.call_function("div", F.abs(wide(diff)) * F.lit(20000).cast("decimal(5,0)") + base, twice)
    return F.when(diff < 0, -whole).otherwise(whole).cast("decimal(38,0)") / F.lit(100).cast("decimal(3,0)")


def signed(n: Column) -> Column:
    """``+5``, ``-3``, ``0``."""
    return F.when(n > 0, F.concat(F.lit("+"), n.cast("string"))).otherwise(n.cast("string"))


def grouped(n: Column) -> Column:
    """Thousands separators, no decimals."""
    return F.format_number(n, 0)
