"""Continuous versions of the collecting jobs.

The stream checkpoint takes the place of hand-kept progress files.  A sink stores batch ``n`` of a run in
``run=<number>-<id>/batch=<n>``, the id being that of the checkpoint: a batch that is replayed after a failure
replaces its own output.  A run that starts anew because its progress was lost has another id, however its
batches are cut, and looks at the rows of all other runs.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listprep.operators.keyindex import KeyIndex, unknown_rows
from listprep.operators.membership import without_known
from listprep.sinks import files
from listprep.sinks.writers import folders, path_exists


def run_name(spark: SparkSession, target: str, checkpoint: str) -> str:
    """Name of the run that belongs to a checkpoint: the one stored before, else the next number."""
    query = json.loads("".join(r.value for r in spark.read.text(f"{checkpoint}/metadata").collect()))["id"]
    runs = [name.removeprefix("run=") for name in folders(spark, target) if name.startswith("run=")]
    own = [name for name in runs if name.endswith(query)]
    return own[0] if own else f"{max([int(name[:9]) for name in runs], default=0) + 1:09d}-{query}"


def earlier(spark: SparkSession, target: str, schema, run: str, number: int) -> DataFrame:
    """Rows of all other runs, and of the batches of this one before ``number``."""
    if not path_exists(spark, target):
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(target)
    names = [f.name for f in schema.fields]
    return rows.filter((F.col("run") != run) | (F.col("batch") < number)).select(*names)


def link_index(spark: SparkSession, target: str, **options) -> KeyIndex:
    """The key index of a stored list: a folder inside it that readers of the list pass over."""
    return KeyIndex(spark, f"{target}/_keys", **options)


def append_batch(
    index: KeyIndex, target: str, batch: DataFrame, run: str, number: int, key: str = "url", order: Sequence[str] = ("pos",)
) -> None:
    """Appends the rows of batch ``number`` of a run whose key is not stored yet, the first row of each key.

    The index's manifest says what is stored.  A batch it names as done was written whole and is left alone.  A batch
    that was begun is named first: if its driver died after writing it, the next batch takes its keys in, so they are
    not stored twice, whoever comes next.  A list that was stored without an index is taken in once."""
    spark = batch.sparkSession
    state = index.manifest()
    if state["done"].get(run, -1) >= number:
        return
    name = F.col(key).cast("string").alias("key")

    def take_in(path: str | None, found: DataFrame | None = None) -> None:
        if found is None:
            found = spark.read.schema(batch.select(key).schema).parquet(path)
        found = found.select(name).filter("key IS NOT NULL").distinct()
        index.add(state, found, found.count())

    if state["version"] == 0 and path_exists(spark, target):
        stored = earlier(spark, target, batch.select(key).schema, run, number)
        take_in(None, stored)
        state["done"] = {n.removeprefix("run="): 1 << 30 for n in folders(spark, target) if n.startswith("run=")}
        state["done"][run] = number - 1
    begun = state["pending"]
    if begun and begun != [run, number]:
        folder = f"{target}/run={begun[0]}/batch={begun[1]}"
        if files.exists(spark, f"{folder}/_SUCCESS"):
            take_in(folder)
        state["done"][begun[0]] = begun[1]
    state["pending"] = [run, number]
    index.commit(state)
    folder = f"{target}/run={run}/batch={number}"
    batch = batch.persist()
    try:
        unknown_rows(batch, index, key, order).write.mode("overwrite").parquet(folder)
    finally:
        batch.unpersist()
    take_in(folder)
    state["done"][run], state["pending"] = number, None
    index.commit(state)


def append_links(
    stream: DataFrame, target: str, checkpoint: str, key: str = "url", order: Sequence[str] = ("pos",), **index_options
) -> StreamingQuery:
    """Appends links not stored yet, the first row of each link in a batch; rows without a link go.

    A batch is compared with all that is stored, of this run and others, by the list's key index (see ``append_batch``),
    so it costs its own size and not the list's, and a replay repeats no link, whatever its batches."""

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        run = run_name(spark, target, checkpoint)
        append_batch(link_index(spark, target, **index_options), target, batch, run, number, key, order)

    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def unseen_links(stream: DataFrame, key: str = "url", stored: DataFrame | None = None) -> DataFrame:
    """Links seen neither in this stream nor in a list stored before it began.

    The stream's own links are kept as state, so a batch costs its own size only, not that of all
    links so far.  Which of several rows of a link stays depends on arrival."""
    fresh = stream if stored is None else stream.join(stored.select(key).distinct(), key, "left_anti")
    return fresh.dropDuplicates([key])


def write_links(links: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet files, each row exactly once."""
    return (
        links.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def recent_links(stream: DataFrame, time: str, delay: str, key: str = "url") -> DataFrame:
    """Bounded-state variant: a link is dropped when it was seen within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def process_pending(
    stream: DataFrame, target: str, checkpoint: str, is_bad, key: str | None = None
) -> StreamingQuery:
    """Splits each batch into results and failures (folders ``bad=false`` and ``bad=true`` of a batch); failures stay
    available as pending work.  With a key, results of other runs are not stored again."""

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        run = run_name(spark, target, checkpoint)
        if key and path_exists(spark, target):
            done = spark.read.parquet(target).filter((F.col("run") != run) & (F.col("bad") == "false")).select(key)
            batch = without_known(batch, done, [key])
        marked = batch.withColumn("bad", F.coalesce(is_bad, F.lit(True)))
        marked.write.mode("overwrite").partitionBy("bad").parquet(f"{target}/run={run}/batch={number}")

    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_tally(stream: DataFrame, target: str, checkpoint: str, status: str = "status") -> StreamingQuery:
    """Rows per status so far.  Each batch stores the whole (one row per status) tally in turn in one
    of two folders, so the last complete state stays readable while the next is written."""

    def sink(batch: DataFrame, number: int) -> None:
        state = batch.withColumn("as_of", F.lit(number).cast("long"))
        state.write.mode("overwrite").parquet(f"{target}/slot={number % 2}")

    return (
        stream.groupBy(status)
        .agg(F.count("*").alias("n"))
        .writeStream.outputMode("complete")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_tally(df: DataFrame) -> DataFrame:
    """The newest state of a stored running tally."""
    newest = df.agg(F.max("as_of")).scalar()
    return df.filter(F.col("as_of") == newest).drop("as_of", "slot")


def append_snapshots(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends count snapshots; a date may come in any number of batches and again in a later one or a later run.
    ``latest_snapshots`` reads them."""

    def sink(batch: DataFrame, number: int) -> None:
        run = run_name(batch.sparkSession, target, checkpoint)
        batch.write.mode("overwrite").parquet(f"{target}/run={run}/batch={number}")

    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_snapshots(stored: DataFrame, keys: Sequence[str] = ("snapshot", "query")) -> DataFrame:
    """The row stored last for each date and query.  Of several in one batch the largest stays."""
    rest = [c for c in stored.columns if c not in (*keys, "run", "batch")]
    newest = F.max(F.struct("run", F.col("batch").cast("long").alias("batch"), *rest)).alias("_row")
    return stored.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
