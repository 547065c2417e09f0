"""Writers.  Outputs are folders of part files, as usual on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listprep.functions.text import clean_strings
from listprep.operators.membership import without_known


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it does not exist."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """Every value quoted, always with a header."""
    mode = "append" if append else "overwrite"
    options = {"header": True, "quoteAll": True, "escape": '"', "emptyValue": ""}
    df.write.mode(mode).options(**options).csv(path)


def export_table(df: DataFrame, path: str) -> None:
    """CSV after removing control characters from every string column."""
    write_csv(clean_strings(df), path)


def next_free(spark: SparkSession, path: str) -> str:
    """The first of ``path_1``, ``path_2`` … that does not exist."""
    number = 1
    while path_exists(spark, f"{path}_{number}"):
        number += 1
    return f"{path}_{number}"


def save_list(df: DataFrame, path: str, mode: str = "continue", key: str = "url") -> str:
    """Saves a link list and returns the folder written.

    ``continue`` appends rows whose key is not stored yet (without a stored list it writes all);
    ``new`` writes to the next free numbered name; ``overwrite`` replaces.
    """
    spark = df.sparkSession
    if mode == "continue":
        if path_exists(spark, path):
            stored = spark.read.schema(df.schema).json(path)
            without_known(df, stored, [key]).write.mode("append").json(path)
        else:
            df.write.json(path)
        return path
    if mode == "new":
        path = next_free(spark, path)
        df.write.json(path)
        return path
    if mode == "overwrite":
        df.write.mode("overwrite").json(path)
        return path
    raise ValueError(f"unknown mode {mode!r}")


def write_records(df: DataFrame, path: str, by: str = "list") -> None:
    """One folder per list, one JSON record per page.

    Rebalancing by list keeps the files few, and splits a list that is too large for one task."""
    df.hint("rebalance", by).write.mode("append").partitionBy(by).json(path)


def write_pages(df: DataFrame, path: str) -> None:
    """One file per page of a paginated frame (column ``page``)."""
    df.repartition("page").write.mode("overwrite").partitionBy("page").json(path)


def write_playlists(df: DataFrame, path: str, by: str = "playlist", url: str = "url") -> None:
    """Unique sorted links, a folder per playlist.  Range partitioning splits a long playlist over
    several part files, whose names keep the order."""
    unique = df.select(by, url).distinct()
    ordered = unique.repartitionByRange(by, url).sortWithinPartitions(by, url)
    ordered.write.mode("overwrite").partitionBy(by).text(path)


def write_report(changes: DataFrame, path: str) -> bool:
    """JSON lines, one change each, only when there is a change.  Returns whether it was written.

    The changes are computed once: written first, and removed again when no row was seen on the way."""
    seen = Observation()
    changes.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
    if seen.get["rows"]:
        return True
    target = changes.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(changes.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return False


def append_errors(bad: DataFrame, path: str, title: str, url: str, message: str) -> None:
    """Error log lines ``[time] title (url): message``."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    line = F.concat(F.lit("["), now, F.lit("] "), F.col(title), F.lit(" ("), F.col(url), F.lit("): "), F.col(message))
    bad.select(line.alias("line")).write.mode("append").text(path)
