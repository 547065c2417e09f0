"""Dated count snapshots and their difference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listprep.functions import numbers

# Fixed value: the message of an error row.
ERROR_MESSAGE = "Ошибка при получении данных"


def latest_two(counts: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """The two newest snapshot names with their role; fails when there are fewer than two."""
    names = counts.select(snapshot).distinct().orderBy(F.desc(snapshot)).limit(2)
    pair = names.agg(F.max(snapshot).alias("current"), F.min(snapshot).alias("previous"), F.count("*").alias("n"))
    enough = F.when(F.col("n") == 2, F.col("previous")).otherwise(F.raise_error(F.lit("need two snapshots to compare")))
    return pair.select(
        F.inline(
            F.array(
                F.struct(F.col("current").alias(snapshot), F.lit("current").alias("role")),
                F.struct(enough.alias(snapshot), F.lit("previous").alias("role")),
            )
        )
    )


def snapshot_diff(counts: DataFrame) -> DataFrame:
    """Changes between the two newest snapshots (snapshot, query, n; NULL n = the count failed).

    Every query of the newer one is looked at: ``error`` when either count failed, ``new`` when the
    older one does not have it, ``changed`` when the counts differ.  Errors come last, then the
    largest change first.  Only the rows of the two snapshots are read: the older name filters the scan, or prunes
    the folders of stored snapshots, before anything is counted; then both meet in one aggregation.
    """
    pair = F.broadcast(latest_two(counts))  # always two rows
    counts = counts.filter(F.col("snapshot") >= latest_two(counts).agg(F.min("snapshot")).scalar())
    now, old = F.col("role") == "current", F.col("role") == "previous"
    both = (
        counts.join(pair, "snapshot")
        .groupBy("query")
        .agg(
            F.max(F.when(now, F.col("n"))).alias("current"),
            F.max(F.when(old, F.col("n"))).alias("previous"),
            F.bool_or(now).alias("_now"),
            F.bool_or(old).alias("_old"),
        )
        .filter("_now")
    )
    failed = F.col("current").isNull() | (F.col("_old") & F.col("previous").isNull())
    status = F.when(failed, "error").when(~F.col("_old"), "new").otherwise("changed")
    ok = F.col("status") != "error"
    diff = F.when(F.col("status") == "changed", F.col("current") - F.col("previous"))
    return (
        both.withColumn("status", status)
        .withColumn("diff", diff)
        .filter((F.col("status") != "changed") | (F.col("diff") != 0))
        .select(
            "query",
            "status",
            F.when(~ok, F.lit(ERROR_MESSAGE)).alias("message"),
            F.when(ok, F.col("previous")).alias("previous"),
            F.when(ok, F.col("current")).alias("current"),
            "diff",
            numbers.percent_2dp(F.col("diff"), F.col("previous")).cast("decimal(38,2)").cast("string").alias("percentage"),
        )
        .orderBy(F.col("status") == "error", F.desc(F.abs("diff")), "query")
    )


def display_line(df: DataFrame) -> DataFrame:
    """One printable line per change."""
    moved = F.concat(
        "query", F.lit(": "), numbers.grouped(F.col("previous")), F.lit(" → "), numbers.grouped(F.col("current")),
        F.lit(" ("), numbers.signed(F.col("diff")), F.lit(", "), F.coalesce("percentage", F.lit("-")), F.lit("%)"),
    )
    return df.select(
        "query",
        F.when(F.col("status") == "changed", moved)
        .when(F.col("status") == "new", F.concat("query", F.lit(": new, "), numbers.grouped(F.col("current"))))
        .otherwise(F.concat("query", F.lit(": "), "message"))
        .alias("line"),
    )
