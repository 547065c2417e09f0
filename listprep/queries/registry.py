"""Registration of queries and helpers to read the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query (spark, folder) -> frame, with the SQL that gives the same rows."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = tune(spark).read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores is dealt out before CPU-heavy parsing or text work.

    For scans only (looking at partitions must not run anything); a table of cluster size has many
    splits and passes unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def escaped(c: Column) -> Column:
    """Text made safe for HTML."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def money(c: Column) -> Column:
    """Amounts as exact text."""
    return c.cast("decimal(15,2)").cast("string")


# Blanks as a class in the dialect of the checking engine.
SQL_WS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"
