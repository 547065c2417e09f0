"""ISO date and time texts, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def iso_datetime(ts: Column) -> Column:
    """Microseconds are written only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
