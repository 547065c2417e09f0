"""Expected against actual, tallies and list statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(expected: DataFrame, actual: DataFrame, by: str = "list") -> DataFrame:
    """Counts per list and in total, their difference and whether they agree."""
    want = expected.groupBy(by).agg(F.count("*").alias("expected"))
    have = actual.groupBy(by).agg(F.count("*").alias("actual"))
    both = want.join(have, by, "full").na.fill(0, ["expected", "actual"])
    totals = both.rollup(by).agg(
        F.sum("expected").alias("expected"),
        F.sum("actual").alias("actual"),
        F.grouping(by).cast("int").alias("is_total"),
    )
    difference = F.col("expected") - F.col("actual")
    return totals.withColumn("difference", difference).withColumn("ok", difference == 0)


def fully_processed(links: DataFrame, outputs: DataFrame, by: str = "list") -> DataFrame:
    """Lists with at least as many outputs as links; error outputs count too."""
    per_list = reconcile(links, outputs, by).filter("is_total = 0")
    return per_list.select(by, "expected", "actual", (F.col("actual") >= F.col("expected")).alias("done"))


def outcome_tally(df: DataFrame, status: str = "status") -> DataFrame:
    """One row: successful, without transcript, failed, total."""
    return df.agg(
        F.count_if(F.col(status) == "successful").alias("successful"),
        F.count_if(F.col(status) == "no_transcript").alias("no_transcript"),
        F.count_if(F.col(status) == "failed").alias("failed"),
        F.count("*").alias("total"),
    )


def list_stats(df: DataFrame, by: str, key: str) -> DataFrame:
    """Rows and distinct keys per list."""
    return df.groupBy(by).agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_unique"))
