"""Retries: what a stream arrives at, in any cut of the input, is what windows over the whole table say."""

import random

import pytest

from listprep import session
from listprep.streaming import jobs, retries


def plain(rows, limit=6):
    """Rounds one attempt after the other."""
    open_, out = {}, {}
    for item, number, at, ok in sorted(rows, key=lambda r: (r[2], r[1])):
        since, n = open_.get(item, (number, 0))
        n += 1
        state = "done" if ok else "given_up" if n == limit else "waiting"
        out[item, since] = (n, at + 10_000 if state == "waiting" else None, state)
        if state == "waiting":
            open_[item] = since, n
        else:
            open_.pop(item, None)
    return {(item, since, *rest) for (item, since), rest in out.items()}


SCHEMA = "item string, id long, at long, ok boolean"


def attempts(seed, n=400, items=9):
    rng = random.Random(seed)
    return [(f"i{min(rng.randrange(items), rng.randrange(items))}", i, 10**12 + i * 1000, rng.random() < 0.15) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_against_plain_counting(spark, seed):
    rows = attempts(seed)
    got = retries.rounds(spark.createDataFrame(rows, SCHEMA)).select("item", "since", "attempts", "due", "state")
    assert {tuple(r) for r in got.collect()} == plain(rows)
    assert retries.rounds(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stream_stopped_in_the_middle_of_a_round(spark, tmp_path):
    rows = attempts(3, 200)
    with session.state_partitions(spark, 2):
        for start in range(0, 200, 100):
            part = rows[start : start + 100]
            random.Random(start).shuffle(part)
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            jobs.write_links(retries.retry_changes(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    changes = spark.read.schema(retries.CHANGES).parquet(str(tmp_path / "out"))
    got = retries.standing(changes).select("item", "since", "attempts", "due", "state")
    assert {tuple(r) for r in got.collect()} == plain(rows)
    # one change for each attempt; the others are timers of rounds that were still open
    assert changes.filter("state <> 'due'").count() == 200
    waiting = {(i, s) for i, s, _, _, state in plain(rows) if state == "waiting"}
    assert changes.filter("state = 'due' AND attempts > 6").count() == 0 and waiting
