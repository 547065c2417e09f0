"""Enrichment and upsert by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.operators.joins import join_unique


def blank_key(df: DataFrame, key: str) -> Column:
    """Whether a row has no key: null, or an empty text."""
    missing = F.col(key).isNull()
    return missing | (F.col(key) == "") if dict(df.dtypes)[key] == "string" else missing


def overlay(base: DataFrame, found: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Base rows with found values put over them; a value not found leaves the old one.

    Of several rows of ``found`` with one key the least counts, column by column.  Rows without a key pass unchanged:
    they get a join key that matches nothing and differs from row to row, so they do not meet in one task.
    """
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in base.columns]).cast("string"))
    text = F.concat(F.lit("="), F.col(key).cast("string"))
    left = base.withColumn("_key", F.when(blank_key(base, key), spread).otherwise(text))
    right = found.filter(~blank_key(found, key)).groupBy(text.alias("_key"))
    right = right.agg(*[F.min(c).alias(f"_new_{c}") for c in columns])
    kept = [c for c in base.columns if c not in columns]
    return join_unique(left, right, ["_key"], "left").select(
        *kept,
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in base.columns else F.col(f"_new_{c}").alias(c) for c in columns],
    )


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Existing rows updated by non-null new values, new columns added, unseen rows appended.

    ``key`` may be a position column (rows aligned by place) or a real key.  New rows with one key count as one (the
    least value of each column); old rows all stay.  Rows without a key meet nothing: old ones stay, new ones are
    appended.
    """
    old_blank, new_blank = blank_key(existing, key), blank_key(new, key)
    left_out, added = existing.filter(old_blank), new.filter(new_blank)
    existing = existing.filter(~old_blank)
    new = new.filter(~new_blank).groupBy(key).agg(*[F.min(c).alias(c) for c in new.columns if c != key])
    names = [c for c in existing.columns if c != key]
    names += [c for c in new.columns if c != key and c not in names]
    left = existing.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in existing.columns if c != key])
    right = new.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in new.columns if c != key])

    def merged(c):
        sides = [F.col(f"_new_{c}")] if c in new.columns else []
        sides += [F.col(f"_old_{c}")] if c in existing.columns else []
        return F.coalesce(*sides).alias(c)

    met = left.join(right, key, "full").select(key, *[merged(c) for c in names])
    for rest in (left_out, added):
        met = met.unionByName(rest, allowMissingColumns=True)
    return met
