"""Dated count snapshots in a store that knows the files of each date.

A batch writes one version: a folder with a part per date.  A manifest (one small file per commit, newest wins) maps each
date to its current versions, and says which batch of each run was stored last.  A date of more than ``FOLD`` versions is
rewritten as one in the same commit.  So a difference opens the files of two dates, however many dates, runs and batches
there are, and no row of another date is read.  Only the manifest passes the driver: a line per date.

One stream writes to a store at a time.  What a lost batch left behind is named by no manifest and is overwritten when
the batch is repeated.  A batch that was stored already is skipped.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from listprep.operators import snapshots
from listprep.sinks import files
from listprep.streaming.jobs import run_name

COUNTS = "snapshot string, query string, n bigint"
# Versions of a date before they are rewritten as one.
FOLD = 4


def _manifest(spark: SparkSession, target: str) -> tuple[int, dict]:
    """Number and content of the newest manifest."""
    numbers = [int(name.removesuffix(".json")) for name in files.names(spark, f"{target}/manifest") if name.endswith(".json") and name[0] != "."]
    if not numbers:
        return 0, {"done": {}, "dates": {}}
    return max(numbers), json.loads(files.read_text(spark, f"{target}/manifest/{max(numbers):010d}.json"))


def _write(rows: DataFrame, folder: str) -> list[str]:
    """Rows by date; the dates' parts are named by the bytes of the date, which keeps their order."""
    part = F.coalesce(F.hex("snapshot"), F.lit("none"))
    writer = rows.withColumn("part", part).hint("rebalance", "part").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy("part").parquet(folder)
    found = files.names(rows.sparkSession, folder)
    return [name.removeprefix("part=") for name in found if name.startswith("part=")]


def _read(spark: SparkSession, target: str, versions: dict[str, list[str]]) -> DataFrame:
    """The row stored last for each date and query; of several in one batch the largest stays."""
    paths = [f"{target}/data/{version}/part={date}" for date, of_date in versions.items() for version in of_date]
    if not paths:
        return spark.createDataFrame([], COUNTS)
    version = F.regexp_extract("_metadata.file_path", "/data/([0-9]+m?)/part=[^/]*/[^/]*$", 1)
    stored = spark.read.schema(COUNTS).parquet(*paths).select("*", version.alias("version"))
    newest = F.max(F.struct("version", "n"))["n"]
    return stored.groupBy("snapshot", "query").agg(newest.alias("n"))


def add_batch(batch: DataFrame, target: str, run: str, number: int) -> bool:
    """Stores a batch of counts; False if this run stored it before."""
    spark = batch.sparkSession
    last, state = _manifest(spark, target)
    if state["done"].get(run, -1) >= number:
        return False
    version = f"{last + 1:010d}"
    crowded = {}
    rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(COUNTS)])
    for date in _write(rows, f"{target}/data/{version}"):
        of_date = state["dates"].setdefault(date, [])
        of_date.append(version)
        if len(of_date) > FOLD:
            crowded[date] = of_date
    if crowded:
        for date in _write(_read(spark, target, crowded), f"{target}/data/{version}m"):
            state["dates"][date] = [f"{version}m"]
    state["done"][run] = number
    files.write_text(spark, f"{target}/manifest/{last + 1:010d}.json", json.dumps(state))
    return True


def store_snapshots(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Adds a stream of counts (snapshot, query, n); a date may come in any number of batches, and again in later runs."""

    def sink(batch: DataFrame, number: int) -> None:
        add_batch(batch, target, run_name(batch.sparkSession, target, checkpoint), number)

    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _part(date: str | None) -> str:
    return "none" if date is None else date.encode().hex().upper()


def read_snapshots(spark: SparkSession, target: str, dates: Iterable[str | None] | None = None) -> DataFrame:
    """Stored counts, of all dates or of some; only their files are opened."""
    known = _manifest(spark, target)[1]["dates"]
    return _read(spark, target, known if dates is None else {p: known[p] for p in map(_part, dates) if p in known})


def stored_diff(spark: SparkSession, target: str) -> DataFrame:
    """Changes between the two newest dates (``snapshots.snapshot_diff``), found in the manifest; a null date is none."""
    known = _manifest(spark, target)[1]["dates"]
    newest = sorted(p for p in known if p != "none")[-2:]
    return snapshots.snapshot_diff(_read(spark, target, {p: known[p] for p in newest}))


def expire(spark: SparkSession, target: str, keep: int = 1) -> int:
    """Removes manifests but the ``keep`` newest, and versions that none of these names; the number of versions removed.

    Readers of older manifests must have ended."""
    last = _manifest(spark, target)[0]
    kept, named = range(max(last - keep, 0) + 1, last + 1), set()
    for number in kept:
        state = json.loads(files.read_text(spark, f"{target}/manifest/{number:010d}.json"))
        named.update(v for versions in state["dates"].values() for v in versions)
    for name in files.names(spark, f"{target}/manifest"):
        if name.endswith(".json") and name[0] != "." and int(name.removesuffix(".json")) not in kept:
            files.remove(spark, f"{target}/manifest/{name}")
    gone = [v for v in files.names(spark, f"{target}/data") if v not in named]
    for version in gone:
        files.remove(spark, f"{target}/data/{version}")
    return len(gone)
