"""Queries: the incremental jobs as streams over staged files, run until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from listprep.queries.lists import SQL_LINKS, raw_links
from listprep.queries.packages import counts
from listprep.queries.registry import SQL, query, table
from listprep.queries.texts import SQL_TRANSCRIPTS, outcomes, transcripts
from listprep.session import state_partitions, work_dir
from listprep.streaming import jobs, retries, snapshotstore


def staged(df, folder, files=4):
    """Writes the input of a stream as a few files and opens it, one file per batch."""
    df.repartition(files).write.mode("append").parquet(folder)
    return opened(df, folder)


def opened(df, folder, files=1):
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query("stream_links", f"with {SQL_LINKS} select distinct href as url from links")
def stream_links(spark, d):
    """Half of the input, then lost progress and all of it in another batch layout: no link twice."""
    work = work_dir(spark, "stream-links")
    links = raw_links(spark, d).select("page_id", "url").withColumnRenamed("page_id", "pos")
    stream = staged(links.filter("pos % 2 = 0"), f"{work}/in")
    jobs.append_links(stream, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    links.filter("pos % 2 = 1").repartition(3).write.mode("append").parquet(f"{work}/in")
    again = opened(links, f"{work}/in", 3)
    jobs.append_links(again, f"{work}/out", f"{work}/checkpoint-again").awaitTermination()
    return spark.read.parquet(f"{work}/out").select("url")


@query(
    "stream_unseen",
    f"with {SQL_LINKS} select distinct href as url from links where href not in (select href from links where stored)",
)
def stream_unseen(spark, d):
    """Stream state for the links of the stream, a join for those stored before."""
    work = work_dir(spark, "stream-unseen")
    links = raw_links(spark, d)
    stream = staged(links.filter("not stored").select("url"), f"{work}/in")
    fresh = jobs.unseen_links(stream, stored=links.filter("stored"))
    with state_partitions(spark):
        jobs.write_links(fresh, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.schema("url string").parquet(f"{work}/out")


@query("stream_resume", "select event_id, case when event_type = 'error' then 'pending' else 'done' end as state from events")
def stream_resume(spark, d):
    """Stopped after the first half and started again, then all of it with lost progress: nothing is lost or stored
    twice."""
    work = work_dir(spark, "stream-resume")
    events = table(spark, d, "events", "event_id", "event_type", "value")

    def run(stream, checkpoint):
        jobs.process_pending(
            stream, f"{work}/out", f"{work}/{checkpoint}", F.col("event_type") == "error", "event_id"
        ).awaitTermination()

    run(staged(events.filter("value < 30"), f"{work}/in", 2), "checkpoint")
    run(staged(events.filter("value >= 30"), f"{work}/in", 2), "checkpoint")
    run(opened(events, f"{work}/in", 4), "checkpoint-again")
    state = F.when(F.col("bad") == "true", "pending").otherwise("done")
    # a failure is pending once, however often it failed
    stored = spark.read.parquet(f"{work}/out").select("event_id", state.alias("state"))
    return stored.groupBy("event_id").agg(F.min("state").alias("state"))


@query(
    "stream_tally",
    f"""
    with {SQL_TRANSCRIPTS}
    select case when raw is null then 'failed' when clean = '' then 'no_transcript' else 'successful' end as status, count(*) as n
    from cleaned group by 1
    """,
)
def stream_tally(spark, d):
    work = work_dir(spark, "stream-tally")
    stream = staged(outcomes(transcripts(spark, d)), f"{work}/in", 3)
    with state_partitions(spark):
        jobs.running_tally(stream, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return jobs.latest_tally(spark.read.parquet(f"{work}/out"))


@query(
    "stream_snapshots",
    """
    select strftime(ts, '%Y-%m-%d') as snapshot, event_type || '-h' || hour(ts) as query,
      case when max(value) <= 300 then count(*) filter (value >= 20) end as n
    from events group by 1, 2
    """,
)
def stream_snapshots(spark, d):
    """Every date comes in several batches, at first with wrong counts; a second run replaces the first."""
    work = work_dir(spark, "stream-snapshots")
    right = counts(spark, d)
    for n, part in enumerate((right.withColumn("n", F.lit(-1).cast("long")), right)):
        stream = staged(part, f"{work}/in-{n}", 3)
        snapshotstore.store_snapshots(stream, f"{work}/out", f"{work}/checkpoint-{n}").awaitTermination()
    return snapshotstore.read_snapshots(spark, f"{work}/out")


@query("stored_diff", SQL["snapshot_diff"])
def stored_diff(spark, d):
    """The change report out of a store that got its counts in several batches; the files of two dates are opened."""
    work = work_dir(spark, "stored-diff")
    stream = staged(counts(spark, d), f"{work}/in", 3)
    snapshotstore.store_snapshots(stream, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return snapshotstore.stored_diff(spark, f"{work}/out")


SQL_ROUNDS = """
    a as (select cast(user_id as varchar) as item, event_id as id, epoch_us(ts) // 1000 as t, event_type = 'purchase' as ok from events),
    p as (select *, coalesce(sum(cast(ok as bigint)) over (partition by item order by t, id rows between unbounded preceding and 1 preceding), 0) as part from a),
    r as (select *, (row_number() over (partition by item, part order by t, id) - 1) // 6 as round from p),
    g as (select item, min(id) as since, cast(count(*) as integer) as attempts, max(t) as t, bool_or(ok) as ok from r group by item, part, round),
    s as (select *, case when ok then 'done' when attempts = 6 then 'given_up' else 'waiting' end as state from g)"""


def attempts(spark, d):
    """Events as attempts of their user; a purchase is a success."""
    events = table(spark, d, "events", "event_id", "user_id", "ts", "event_type")
    return events.select(
        F.col("user_id").cast("string").alias("item"), F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at"),
        (F.col("event_type") == "purchase").alias("ok"), F.dayofmonth("ts").alias("day"),
    )


@query(
    "stream_retries",
    f"with {SQL_ROUNDS} select item, since, attempts, state, case when state = 'waiting' then t + 10000 end as due from s",
)
def stream_retries(spark, d):
    """Attempts of ten days at a time; the stream is stopped and started again in the middle."""
    work = work_dir(spark, "stream-retries")
    every = attempts(spark, d)
    with state_partitions(spark):
        for first, last in ((0, 10), (11, 20), (21, 31)):
            part = every.filter(F.col("day").between(first, last)).drop("day")
            part.coalesce(1).write.mode("append").parquet(f"{work}/in")
            changes = retries.retry_changes(opened(part, f"{work}/in"))
            jobs.write_links(changes, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return retries.standing(spark.read.schema(retries.CHANGES).parquet(f"{work}/out"))


@query(
    "retry_rounds",
    f"with {SQL_ROUNDS} select item, since, attempts, state, case when state = 'waiting' then t + 10000 end as due from s",
)
def retry_rounds(spark, d):
    return retries.rounds(attempts(spark, d).drop("day"))
