"""Evaluate an expression once and use it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside generators and lambdas, where Spark
    does not share common parts."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
