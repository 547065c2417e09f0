"""List building by key: incremental append, exclusion, pending work and resume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.functions import text
from listprep.operators.joins import drop_known, join_unique


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first whole row per key.  Partial aggregation runs before the shuffle, so copies of one
    hot key shrink to one row per map task."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def without_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not known; duplicates and all columns stay.

    The known side is made unique first (partial aggregation); a hot key of the other side is split
    at run time (see ``joins``)."""
    return drop_known(df, known, keys)


def append_new(batch: DataFrame, existing: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of the batch to append: unseen keys only, the first row of each key.

    Both sides are unique and partitioned by the key before they meet, so the join adds no shuffle
    and has no hot key."""
    return first_rows(batch, [key], order).join(existing.select(key).distinct(), key, "left_anti").select(*batch.columns)


def continue_list(existing: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """The saved list plus unseen batch rows.  Only the saved list is looked at: copies inside the
    batch stay."""
    fresh = without_known(batch, existing, [key])
    return existing.withColumn("is_new", F.lit(False)).unionByName(
        fresh.withColumn("is_new", F.lit(True)), allowMissingColumns=True
    )


def start_offset(df: DataFrame, pos: str, start: int | Column) -> DataFrame:
    """Rows from position ``start`` (a number or a scalar) on (0-based)."""
    return df.filter(F.col(pos) >= start)


def resume_after(df: DataFrame, pos: str, key: str, last_key: Column, inclusive: bool = False) -> DataFrame:
    """Rows after the first one holding the last processed key; an unknown key means from the start.

    ``last_key`` is a literal or a scalar subquery; the position is a scalar subquery as well, so
    nothing is joined or collected.
    """
    found = df.filter(F.col(key) == last_key).agg(F.min(pos).alias("p")).scalar()
    if inclusive:
        return df.filter(F.col(pos) >= F.coalesce(found, F.lit(0)))
    return df.filter(F.col(pos) > F.coalesce(found, F.lit(-1)))


def valid_items(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Items with a url; a missing title becomes ``item_<pos>``."""
    return df.filter(F.col("url").isNotNull()).withColumn(
        "title", F.coalesce(F.col("title"), F.concat(F.lit("item_"), F.col(pos).cast("string")))
    )


def has_error(json: Column) -> Column:
    """A stored record with a top-level ``error`` key; unreadable records do not count as errors."""
    return F.coalesce(F.array_contains(F.json_object_keys(json), "error"), F.lit(False))


def quarantine(df: DataFrame, is_bad: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows); NULL counts as bad."""
    bad = F.coalesce(is_bad, F.lit(True))
    return df.filter(~bad), df.filter(bad)


def pending_or_failed(links: DataFrame, outputs: DataFrame) -> DataFrame:
    """Links still to be processed: without an output, or with one that holds an error.

    links: list, pos, title, url (``pos`` unique in a list).  outputs: list, has_error, and ``url`` or ``safe_name`` or
    both.  An output with a url belongs to the links with that url.  One without is found by its name, under any of the
    three naming schemes, the first scheme first; names are cut and cleaned, so a name that several links of the list
    would have tells nothing, and those links stay pending.  Of several outputs one with an error counts.

    Only positions and names are shuffled to find the outputs; the links meet the result once."""
    names = [
        text.safe_title(F.col("title"), F.col("pos")),
        text.old_title(F.col("title")),
        text.basic_title(F.col("title")),
    ]
    named = outputs
    if "url" in outputs.columns:
        named = outputs.filter(F.col("url").isNull())
    named = named.groupBy("list", "safe_name").agg(F.bool_or("has_error").alias("has_error"))
    tried = links.select(
        "list", "pos", F.posexplode(F.array(*names)).alias("rank", "safe_name")
    )
    # names of exactly one link, with the first scheme that gives them
    own = tried.groupBy("list", "safe_name").agg(F.min("pos").alias("pos"), F.max("pos").alias("_last"), F.min("rank").alias("rank"))
    own = own.filter(F.col("pos") == F.col("_last"))
    # rank and error flag in one integer: the smallest is the first scheme that has an output
    hit = F.min(F.col("rank") * 2 + F.col("has_error").cast("int")).alias("_hit")
    # both are dealt out by name; Spark, going by the size of the compressed files, would gather one of them on the driver
    by_name = own.join(named.hint("merge"), ["list", "safe_name"]).groupBy("list", "pos").agg(hit)
    found = join_unique(links, by_name, ["list", "pos"], "left").withColumn("_failed", F.col("_hit") % 2 == 1)
    if "url" in outputs.columns:
        by_url = outputs.filter(F.col("url").isNotNull()).groupBy("list", "url").agg(F.bool_or("has_error").alias("_error"))
        found = join_unique(found, by_url, ["list", "url"], "left").withColumn("_failed", F.coalesce("_error", "_failed"))
    return found.filter(F.coalesce("_failed", F.lit(True))).select(
        "list", "pos", "title", "url", F.col("_failed").isNotNull().alias("failed_before")
    )
