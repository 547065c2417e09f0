"""Joins of a table that may have hot keys with a side of unique keys.

Adaptive execution splits a hot partition only when both inputs of the join come straight from a
shuffle.  A unique side made by an aggregation is already partitioned by its key, Spark would reuse
that, and the hot key of the other side would stay in one task.  A hash of the key as an additional
join column makes Spark shuffle the unique side once more (it is small compared with the table), and
sorting by a number first is cheaper as well.  A side below the broadcast threshold, by its measured
size, is broadcast as usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(left: DataFrame, unique: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left`` (any number of rows per key) joined with ``unique`` (one row per key)."""
    mark = F.xxhash64(*keys)
    joined = left.withColumn("_h", mark).join(unique.withColumn("_h", mark), ["_h", *keys], how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in unique.columns if c not in keys]
    return joined.select(*left.columns, *added)


# Bytes of values up to which the narrow side of ``join_stored`` is sent to all tasks.
SENT_BYTES = 4 << 20


def join_stored(wide: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``wide`` (records that hold whole pages) inner joined with a stored table of narrow rows, which is sent to all
    tasks if its values are small, as measured now, and within the broadcast threshold; else both sides are shuffled.

    The choice isn't left to Spark, which goes by the size of the files read: records made from compressed pages are many
    times that, and would be gathered on the driver."""
    bytes_ = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in stored.columns]
    size = stored.agg(F.sum(sum(bytes_, F.lit(16)))).first()[0] or 0
    most = min(SENT_BYTES, stored.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return wide.join(F.broadcast(stored) if size <= most else stored.hint("merge"), list(keys))


def keep_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is known."""
    return join_unique(df, known.select(*keys).distinct(), keys, "left_semi")


def drop_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known; duplicates and all columns stay."""
    return join_unique(df, known.select(*keys).distinct(), keys, "left_anti")
