"""Counts by date in a store: what is stored last counts, a difference opens two dates, a replay changes nothing."""

from listprep.operators import snapshots
from listprep.streaming import snapshotstore as store


def frame(spark, rows):
    return spark.createDataFrame(rows, store.COUNTS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_last_stored_counts_and_replays_are_skipped(spark, tmp_path):
    out = str(tmp_path / "s")
    assert rows_of(store.read_snapshots(spark, out)) == []
    assert store.add_batch(frame(spark, [("d1", "q", 1), ("d1", "r", None), ("a/b:c", "q", 5), (None, "q", 7)]), out, "run", 0)
    assert store.add_batch(frame(spark, [("d1", "q", None), ("d2", "q", 2), ("d2", "q", 3)]), out, "run", 1)
    assert not store.add_batch(frame(spark, [("d1", "q", 99)]), out, "run", 1)
    assert store.add_batch(frame(spark, [("d2", None, 4)]), out, "other run", 0)
    assert store.add_batch(frame(spark, []), out, "other run", 1)
    want = [("d1", "q", None), ("d1", "r", None), ("a/b:c", "q", 5), (None, "q", 7), ("d2", "q", 3), ("d2", None, 4)]
    assert rows_of(store.read_snapshots(spark, out)) == sorted(want, key=str)
    assert rows_of(store.read_snapshots(spark, out, ["a/b:c", None, "none"])) == sorted([("a/b:c", "q", 5), (None, "q", 7)], key=str)


def test_what_a_lost_batch_left_is_overwritten(spark, tmp_path):
    out = str(tmp_path / "s")
    store.add_batch(frame(spark, [("d1", "q", 1)]), out, "run", 0)
    # written, but the manifest never came
    store._write(frame(spark, [("d1", "q", 50), ("d9", "q", 50)]), f"{out}/data/0000000002")
    assert rows_of(store.read_snapshots(spark, out)) == [("d1", "q", 1)]
    store.add_batch(frame(spark, [("d2", "q", 2)]), out, "run", 1)
    assert rows_of(store.read_snapshots(spark, out)) == [("d1", "q", 1), ("d2", "q", 2)]


def test_a_difference_opens_two_dates_of_many(spark, tmp_path):
    out, per_date = str(tmp_path / "s"), {}
    for number in range(store.FOLD + 2):
        rows = [(f"2024-{d:03d}", f"q{q}", d * q + number) for d in range(100) for q in range(number % 2, 12, 2)]
        store.add_batch(frame(spark, rows), out, "run", number)
        per_date |= {row[:2]: row for row in rows}
    every = frame(spark, list(per_date.values()))
    assert rows_of(store.read_snapshots(spark, out)) == rows_of(every)
    diff = store.stored_diff(spark, out)
    assert diff.count() and diff.collect() == snapshots.snapshot_diff(every).collect()
    dates = {path.split("/part=")[1].split("/")[0] for path in diff.inputFiles()}
    assert dates == {store._part("2024-098"), store._part("2024-099")}
    # folded once, one version since
    assert all(len(v) == 2 for v in store._manifest(spark, out)[1]["dates"].values())
    assert store.expire(spark, out) == store.FOLD + 1
    assert rows_of(store.read_snapshots(spark, out)) == rows_of(every)
    assert store.expire(spark, out) == 0
