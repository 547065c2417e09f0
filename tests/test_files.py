"""Readers, writers and streams over real files."""

import json

from pyspark.sql import functions as F

from listprep.operators import snapshots
from listprep.sinks import writers
from listprep.sources import readers
from listprep.streaming import jobs


def put(folder, name, value):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


def test_query_files(spark, tmp_path):
    put(tmp_path / "r", "react-packages.json", ["a", "b"])
    put(tmp_path / "r", "vue-packages.json", "[\n  \"b\"\n]")
    put(tmp_path / "r", "progress.json", {"x": 1})
    got = sorted(tuple(r) for r in readers.query_files(spark, str(tmp_path / "r")).collect())
    assert got == [("react", 0, "a"), ("react", 1, "b"), ("vue", 0, "b")]


def test_snapshots_keep_null_counts(spark, tmp_path):
    put(tmp_path / "s", "package-counts-2024-01-01.json", {"a": 1, "b": None})
    put(tmp_path / "s", "package-counts-2024-01-02.json", {"a": 3, "b": 4})
    put(tmp_path / "s", "other.json", {"a": 9})
    frame = readers.snapshots(spark, str(tmp_path / "s"))
    assert sorted((tuple(r) for r in frame.collect()), key=str) == [
        ("2024-01-01", "a", 1), ("2024-01-01", "b", None), ("2024-01-02", "a", 3), ("2024-01-02", "b", 4)]
    assert [(r.query, r.status) for r in snapshots.snapshot_diff(frame).collect()] == [("a", "changed"), ("b", "error")]


def test_json_links(spark, tmp_path):
    put(tmp_path / "j", "good.json", [{"title": "t", "url": "u"}, {"title": "no url"}, 5, {"url": "v"}])
    put(tmp_path / "j", "object.json", {"title": "t", "url": "u"})
    put(tmp_path / "j", "broken.json", "[{")
    good, bad = readers.json_links(spark, str(tmp_path / "j"))
    assert sorted((tuple(r) for r in good.collect()), key=str) == [(0, "t", "u"), (3, None, "v")]
    assert bad.count() == 2
    missing, _ = readers.json_links(spark, str(tmp_path / "none"))
    assert missing.isEmpty() and missing.columns == ["pos", "title", "url"]


def test_stored_pages(spark, tmp_path):
    put(tmp_path / "h", "a.html", "<p>\n1</p>")
    put(tmp_path / "h", "b.txt", "no")
    assert [r.html for r in readers.stored_pages(spark, str(tmp_path / "h")).collect()] == ["<p>\n1</p>"]


def test_csv_links_takes_the_first_column(spark, tmp_path):
    put(tmp_path, "l.csv", 'link,extra\nhttps://a,1\n"https://b,c",2\n')
    assert [r.link for r in readers.csv_links(spark, str(tmp_path / "l.csv")).collect()] == ["https://a", "https://b,c"]


def test_csv_is_quoted_and_has_a_header(spark, tmp_path):
    df = spark.createDataFrame([('say "x"', "")], "a string, b string").coalesce(1)
    writers.write_csv(df, str(tmp_path / "o"))
    (part,) = (tmp_path / "o").glob("part-*.csv")
    assert part.read_text().splitlines() == ['"a","b"', '"say ""x""",""']


def test_save_modes(spark, tmp_path):
    path = str(tmp_path / "list")
    one = spark.createDataFrame([("a",), ("b",)], "url string")
    two = spark.createDataFrame([("b",), ("c",), ("c",)], "url string")
    read = lambda p: sorted(r.url for r in spark.read.schema("url string").json(p).collect())
    assert writers.save_list(one, path) == path and read(path) == ["a", "b"]
    writers.save_list(two, path)
    assert read(path) == ["a", "b", "c", "c"]
    assert writers.save_list(one, path, mode="new") == f"{path}_1"
    assert writers.save_list(one, path, mode="new") == f"{path}_2"
    writers.save_list(one, path, mode="overwrite")
    assert read(path) == ["a", "b"]


def test_report_only_when_there_is_something(spark, tmp_path):
    changes = spark.createDataFrame([("g", "1", "2")], "group_id string, old_version string, new_version string")
    assert not writers.write_report(changes.filter("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert writers.write_report(changes, str(tmp_path / "some"))


def test_error_log(spark, tmp_path):
    bad = spark.createDataFrame([("T", "u", "boom")], "title string, url string, msg string")
    writers.append_errors(bad, str(tmp_path / "log"), "title", "url", "msg")
    line = spark.read.text(str(tmp_path / "log")).first().value
    assert line.startswith("[") and line.endswith("] T (u): boom")


def test_playlist_files_are_sorted(spark, tmp_path):
    df = spark.createDataFrame([("p", f"u{i % 40:02d}") for i in range(100)], "playlist string, url string")
    writers.write_playlists(df, str(tmp_path / "p"))
    lines = [x for f in sorted((tmp_path / "p" / "playlist=p").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == [f"u{i:02d}" for i in range(40)]


def test_stream_replay_changes_nothing(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    links = spark.createDataFrame([(i, f"u{i % 5}") for i in range(20)], "pos int, url string")
    links.repartition(2).write.parquet(folder)

    def run(checkpoint):
        stream = spark.readStream.schema(links.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.append_links(stream, out, str(tmp_path / checkpoint)).awaitTermination()
        return sorted(r.url for r in spark.read.parquet(out).collect())

    assert run("c1") == [f"u{i}" for i in range(5)]
    assert run("c1") == [f"u{i}" for i in range(5)]
    # the progress is lost: every batch comes again and replaces its own output
    assert run("c2") == [f"u{i}" for i in range(5)]


def test_recent_links_bounded_state(spark, tmp_path):
    folder = str(tmp_path / "in")
    df = spark.createDataFrame([("2024-01-01 00:00:00", "a"), ("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "b")], "t string, url string")
    df.select(F.col("t").cast("timestamp"), "url").write.parquet(folder)
    stream = spark.readStream.schema("t timestamp, url string").parquet(folder)
    found = []
    query = (
        jobs.recent_links(stream, "t", "1 hour").writeStream.foreachBatch(lambda b, _: found.extend(r.url for r in b.collect()))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(found) == ["a", "b"]


def test_snapshots_spread_over_batches_keep_all_rows(spark, tmp_path):
    rows = [("2024-01-01", f"q{i}", i) for i in range(10)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "snapshot string, query string, n bigint"
    for part in (rows[:4], rows[4:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.append_snapshots(stream(), out, str(tmp_path / "c1")).awaitTermination()
    assert {tuple(r) for r in jobs.latest_snapshots(spark.read.parquet(out)).collect()} == set(rows)
    spark.createDataFrame([("2024-01-01", "q3", 33)], schema).write.mode("append").parquet(source)
    jobs.append_snapshots(stream(), out, str(tmp_path / "c1")).awaitTermination()
    got = {tuple(r) for r in jobs.latest_snapshots(spark.read.parquet(out)).collect()}
    assert got == {r for r in rows if r[1] != "q3"} | {("2024-01-01", "q3", 33)}


def test_links_replayed_in_another_layout_stay_unique(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "url string, pos int"
    for n in range(4):
        spark.createDataFrame([(f"u{n * 3 + i}", i) for i in range(3)], schema).coalesce(1).write.mode("append").parquet(source)
    for checkpoint, files in (("c1", 1), ("c2", 100), ("c3", 2)):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
        jobs.append_links(stream, out, str(tmp_path / checkpoint)).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == sorted(f"u{i}" for i in range(12))
