"""Versions per package and version checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listprep.functions import versions
from listprep.operators.joins import join_unique


def top_versions(df: DataFrame, n: int = 20, package: str = "pkg", version: str = "version") -> DataFrame:
    """The ``n`` highest versions per package by semantic version order, with their ``rank``.

    Each version counts once.  Invalid versions are left out (see ``split_versions``).  Spark keeps
    only ``n`` rows per package and map task before the shuffle (window group limit).
    """
    unique = df.select(package, version).distinct()
    keyed = unique.filter(versions.is_semver(F.col(version))).withColumn("_key", versions.order_key(F.col(version)))
    newest = Window.partitionBy(package).orderBy(F.desc("_key"), F.asc(version))
    return keyed.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n).drop("_key")


def split_versions(df: DataFrame, version: str = "version") -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows by semantic version rules."""
    ok = F.coalesce(versions.is_semver(F.col(version)), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def ranked_versions(df: DataFrame, n: int = 20, package: str = "pkg", version: str = "version") -> tuple[DataFrame, DataFrame]:
    """(``top_versions``, the distinct versions that have no rank as they are invalid or over 64 bits)."""
    _, invalid = split_versions(df.select(package, version), version)
    return top_versions(df, n, package, version), invalid.distinct()


def head_versions(df: DataFrame, n: int = 3, package: str = "pkg", pos: str = "pos") -> DataFrame:
    """The first ``n`` versions per package in the given order."""
    given = Window.partitionBy(package).orderBy(pos)
    return df.withColumn("rank", F.row_number().over(given)).filter(F.col("rank") <= n)


def latest_version(listing: DataFrame, keys: Sequence[str], version: str = "version", order: str = "lexical") -> DataFrame:
    """Latest numeric-looking version per key.

    ``lexical`` compares as text (so 9.0 stands above 10.0); ``numeric`` compares number by number.
    """
    numeric = listing.filter(versions.is_numeric(F.col(version)))
    if order == "lexical":
        return numeric.groupBy(*keys).agg(F.max(version).alias("latest"))
    if order == "numeric":
        # numbers of any length: without leading zeros the longer one is larger, else the text decides
        bare = F.transform(
            F.filter(F.split(F.col(version), r"\."), lambda p: p != ""), lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        )
        parts = F.transform(bare, lambda p: F.struct(F.length(p).alias("digits"), p.alias("number")))
        return numeric.groupBy(*keys).agg(F.max(F.struct(parts.alias("parts"), F.col(version))).alias("_m")).select(
            *keys, F.col(f"_m.{version}").alias("latest")
        )
    raise ValueError(f"unknown order {order!r}")


def check_versions(current: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current versions with ``new_version`` (the latest when known) and ``changed``."""
    moved = F.col("latest").isNotNull() & (F.col("latest") != F.col("latest_version"))
    return join_unique(current, latest, keys, "left").select(
        *current.columns, F.coalesce("latest", "latest_version").alias("new_version"), moved.alias("changed")
    )


def version_changes(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The change report of ``check_versions``."""
    return checked.filter("changed").select(
        *keys, F.col("latest_version").alias("old_version"), "new_version"
    )


def semver_order(df: DataFrame, version: str = "version") -> list[Column]:
    """Sort columns, lowest version first."""
    return [versions.semver_key(F.col(version)), F.col(version)]
