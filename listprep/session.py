"""Session defaults, reliable checkpoints and shared work folders."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here relies on; all can be set on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # small shuffles still use all cores: page parsing behind a join is heavy for its bytes
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # hot join keys are split at run time, also below an aggregate
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # whole pages travel to the HTML stage: bound the batch in rows and bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # streaming state outside the heap, written as increments
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# One shuffle partition should hold about this much, so that it sorts and aggregates in memory.
SHUFFLE_PARTITION_BYTES = 128 << 20


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Runtime settings; with the size of the largest shuffle also the number of its partitions
    (adaptive execution joins small ones again)."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        partitions = max(spark.sparkContext.defaultParallelism, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return spark


def build(app: str = "listprep", master: str | None = None, cores: int | None = None) -> SparkSession:
    """Session for scripts and tests; on a cluster the master comes from spark-submit."""
    # checkpoint files go when nothing refers to them any more
    builder = SparkSession.builder.appName(app).config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    return tune(builder.getOrCreate())


@contextmanager
def state_partitions(spark: SparkSession, count: int | None = None) -> Iterator[None]:
    """Number of state partitions of streams started inside; it stays fixed for their whole life.
    By default one per core, as each one is a store that every batch opens."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(count or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="listprep-")
    return _LOCAL_ROOTS[context.applicationId]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unused folder below the shared root."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and cuts the lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)
