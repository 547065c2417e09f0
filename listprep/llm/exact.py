"""Exact de-duplication as a stateful stream.

Digests of all texts form a stream. A streaming aggregation keeps one state row per digest on disk (RocksDB) and
never expires it: the smallest ``doc_id`` seen, how many rows were seen, and where the kept row lies (file, row).
The aggregation is partial before the shuffle, so a text that a third of all rows share reaches its state as one row
per task. Rows whose digest was seen before are hits; their whole normalised bytes are compared with those of the
kept row, hot groups in slices. Where bytes differ in spite of equal digests, the group is split by its bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm.registry import BLANKS, documents, narrow, query, stored, unused, whole
from listprep.session import work_dir

# State on disk; its native memory is bounded for each executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
}

# Rows of one slice of a group while bytes are compared.
SLICE = 512

SIGNATURE = "doc_id long, digest string, n_bytes long, file string, row long"


def normalised(text: Column) -> Column:
    """Runs of white space become one blank; null is empty."""
    return F.regexp_replace(whole(text), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def signatures(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One slim row per document: digest and size of the normalised text, and where the text lies
    (file and row where the table is made of files, else null)."""
    place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        docs.select(*place).schema  # noqa: B018 - a union or a join has no places
    except AnalysisException:
        place = F.lit(None).cast("string"), F.lit(None).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normalised(F.col("text")).alias("_text"),
        place[0].alias("file"),
        place[1].alias("row"),
    ).select(
        "doc_id",
        digest(F.col("_text")).alias("digest"),
        F.octet_length("_text").cast("long").alias("n_bytes"),
        "file",
        "row",
    )


def seen(stream: DataFrame) -> DataFrame:
    """Keyed state over a stream (or a table) of signatures: per digest the kept row, its place and the
    number of rows. No watermark, hence no expiry."""
    return stream.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "file", "row")).alias("kept"),
        F.count("*").alias("group_size"),
    )


def run_stream(spark: SparkSession, source: str, state: str, out: str) -> None:
    """Brings the state below ``state`` up to date with the signature files below ``source`` and appends every
    changed state row to ``out``. Call it again after new files came; a lost executor or driver repeats the
    open batch only."""
    signed = spark.readStream.schema(SIGNATURE).option("maxBytesPerTrigger", str(64 << 30)).parquet(source)

    def put(batch: DataFrame, number: int) -> None:
        batch.select(
            "digest",
            F.col("kept.doc_id").alias("keep_id"),
            F.col("kept.file").alias("file"),
            F.col("kept.row").alias("row"),
            "group_size",
        ).write.mode("overwrite").parquet(f"{out}/batch={number}")

    with _state_settings(spark):
        stream = (
            seen(signed)
            .writeStream.outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .foreachBatch(put)
            .start()
        )
        stream.awaitTermination()


def newest(spark: SparkSession, out: str) -> DataFrame:
    """The state as written by ``run_stream``: the row of the latest batch of each digest."""
    rows = spark.read.schema("digest string, keep_id long, file string, row long, group_size long, batch long")
    rows = rows.parquet(out)
    last = F.max(F.struct("batch", "keep_id", "group_size"))
    return rows.groupBy("digest").agg(last.alias("_s")).select("digest", "_s.keep_id", "_s.group_size")


def _sides(docs: DataFrame, state: DataFrame, digest) -> DataFrame:
    """Texts of all groups with several rows, with their kept row and a slice number."""
    groups = narrow(state.filter("group_size > 1").withColumnsRenamed({"digest": "_d"}))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    texts = texts.withColumn("digest", digest(F.col("text")))
    return texts.join(groups, texts.digest == groups._d).select("doc_id", "text", "digest", "keep_id", "group_size")


def differing(copies: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """Digests whose rows do not all hold the same bytes. Each slice of a group has its own copy of the kept
    text, so no task gets a whole hot group."""
    slices = F.ceil(F.col("group_size") / slice_rows).cast("int")
    kept = (
        copies.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest", "group_size")
        .agg(F.min("text").alias("kept_text"))
        .select(F.col("digest").alias("_d"), "kept_text", F.explode(F.sequence(F.lit(0), slices - 1)).alias("_s"))
    )
    rows = copies.select("digest", "text", F.pmod(F.xxhash64("doc_id", "text"), slices).cast("int").alias("slice"))
    both = rows.join(kept, (rows.digest == kept._d) & (rows.slice == kept._s))
    return both.filter(F.col("text") != F.col("kept_text")).select(F.col("digest").alias("_d")).distinct()


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are one group; rows that repeat doc_id and text share their flag and are all counted;
    a null doc_id loses against any other and stays only where its group has no other; an empty table gives no
    rows; other columns are ignored. ``digest`` may be any function of the text: rows with equal digests and
    different bytes are told apart."""
    spark = docs.sparkSession
    base = work_dir(spark, "exact")
    signatures(docs, digest).write.parquet(f"{base}/signatures")
    signed = spark.read.schema(SIGNATURE).parquet(f"{base}/signatures")
    spark.createDataFrame([], "digest string, keep_id long, file string, row long, group_size long").write.parquet(
        f"{base}/seen/batch=-1"
    )
    run_stream(spark, f"{base}/signatures", f"{base}/state", f"{base}/seen")
    state = newest(spark, f"{base}/seen").withColumnRenamed("digest", "_k")
    groups = stored(state, "exact-groups")
    copies = stored(_sides(docs, groups.withColumnRenamed("_k", "digest"), digest), "exact-copies")
    split = stored(differing(copies), "exact-differing")
    sure = signed.join(groups, signed.digest == groups._k).join(split, F.col("digest") == split._d, "left_anti")
    flags = sure.select("doc_id", "keep_id", "group_size", "digest")
    if digest is sha256:
        flags = flags.withColumnRenamed("digest", "text_sha256")
    else:
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("_t"))
        own = own.select("doc_id", digest(F.col("_t")).alias("digest"), sha256(F.col("_t")).alias("text_sha256"))
        flags = own.join(groups, own.digest == groups._k).join(split, F.col("digest") == split._d, "left_anti")
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    doubtful = copies.join(split, copies.digest == split._d, "left_semi").withColumn("text_sha256", sha256(F.col("text")))
    owners = doubtful.groupBy(F.col("text").alias("_t")).agg(
        F.min("doc_id").alias("keep"), F.count("*").alias("size")
    )
    told = doubtful.join(owners, doubtful.text == owners._t).select(
        "doc_id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "text_sha256"
    )
    return (
        flags.select(columns)
        .unionByName(told)
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Those that go are the smaller part, so they are looked
    up, and texts stay where they are if there are few."""
    id_, sha = unused("_gone_id", *docs.columns), unused("_sha", *docs.columns)
    gone = deduplicate(docs).filter("NOT kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha))
    gone = narrow(stored(gone.distinct(), "exact-gone"))
    match = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (sha256(normalised(F.col("text"))) == F.col(sha))
    return docs.join(gone, match, "left_anti")


@query(
    "op3_exact_dedup",
    sql=r"""
    WITH t AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    ), g AS (
        SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
    )
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
    FROM t JOIN g USING (text_sha256)
    """,
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(documents(spark, folder))
