"""Operators on small inputs: properties, edge cases and brute force."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from listprep.operators import enrich, fetchplan, filters, membership, numbering, packages, reconcile, search, snapshots


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- lists ---


def test_append_twice_is_append_once(spark):
    batch = spark.createDataFrame([(i, f"u{i % 7}") for i in range(30)], "pos int, url string")
    stored = spark.createDataFrame([("u3",)], "url string")
    first = membership.append_new(batch, stored, "url", ["pos"])
    assert rows(first, "pos") == [(0, "u0"), (1, "u1"), (2, "u2"), (4, "u4"), (5, "u5"), (6, "u6")]
    again = membership.append_new(batch, stored.union(first.select("url")), "url", ["pos"])
    assert again.isEmpty()


def test_continue_keeps_copies_inside_the_batch(spark):
    old = spark.createDataFrame([("a",)], "url string")
    new = spark.createDataFrame([("a",), ("b",), ("b",)], "url string")
    got = membership.continue_list(old, new)
    assert rows(got, "url", "is_new") == [("a", False), ("b", True), ("b", True)]


def test_pending_and_done_make_all(spark):
    everything = spark.range(100).withColumnRenamed("id", "k")
    done = spark.createDataFrame([(i,) for i in (1, 5, 5, 99, 500)], "k long")
    pending = membership.without_known(everything, done, ["k"])
    assert sorted(r.k for r in pending.collect()) == [i for i in range(100) if i not in (1, 5, 99)]


@pytest.mark.parametrize("last, inclusive, expected", [("b", False, ["c", "b2"]), ("b", True, ["b", "c", "b2"]), ("?", False, ["a", "b", "c", "b2"])])
def test_resume(spark, last, inclusive, expected):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "b2")], "pos int, k string")
    got = membership.resume_after(df, "pos", "k", F.lit(last), inclusive)
    assert [r.k for r in got.orderBy("pos").collect()] == expected


def test_pending_under_three_schemes(spark):
    links = spark.createDataFrame(
        [("l", i, t, f"u{i}") for i, t in enumerate(["Plain", "A: b", "C: d", "E: f", "None", "Bad?"])],
        "list string, pos int, title string, url string",
    )
    outputs = spark.createDataFrame(
        # new scheme, old scheme, plain scheme with error, new scheme good but plain one failed
        [("l", "Plain", False), ("l", "A_b", False), ("l", "C__d", True), ("l", "E_f", False), ("l", "E__f", True), ("other", "None", False)],
        "list string, safe_name string, has_error boolean",
    )
    got = membership.pending_or_failed(links, outputs)
    assert rows(got.select("title", "failed_before"), "title") == [("Bad?", False), ("C: d", True), ("None", False)]


def test_pending_by_identity(spark):
    long = "x" * 120
    titles = [long + "a", long + "b", "Same!", "Same?", "Own", "Other"]
    links = spark.createDataFrame([("l", i, t, f"u{i}") for i, t in enumerate(titles)], "list string, pos int, title string, url string")
    outputs = spark.createDataFrame(
        [("l", "x" * 100, None, False), ("l", "Same", None, False), ("l", "Own", None, True), ("l", None, "u0", False), ("l", "Own", "u5", False)],
        "list string, safe_name string, url string, has_error boolean",
    )
    got = membership.pending_or_failed(links, outputs)
    # names that two links would have count for none of them; a url counts for its link only
    assert rows(got.select("pos", "failed_before"), "pos") == [(1, False), (2, False), (3, False), (4, True)]


def test_error_records(spark):
    df = spark.createDataFrame([('{"error": "x"}',), ('{"a": {"error": 1}}',), ("{broken",), (None,)], "j string")
    assert [r[0] for r in df.select(membership.has_error(F.col("j"))).collect()] == [True, False, False, False]


# --- filters ---


def test_keys_that_are_typed_blank_or_repeated(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k bigint, name string")
    new = spark.createDataFrame([(2, "y"), (2, "x"), (3, "z"), (None, "n")], "k bigint, name string")
    assert rows(enrich.upsert(old, new, "k"), "name") == [(1, "a"), (None, "d"), (None, "n"), (2, "x"), (2, "x"), (3, "z")]
    assert rows(enrich.overlay(old, new, "k", ["name"]), "name") == [(1, "a"), (None, "d"), (2, "x"), (2, "x")]
    blank = spark.createDataFrame([("", str(i)) for i in range(30)], "k string, name string")
    assert enrich.upsert(blank, blank, "k").count() == 60


def test_numbers_of_any_size(spark):
    from listprep.functions import numbers
    from listprep.operators import packages

    versions = ["1." + "9" * 40, "1.1" + "0" * 40, "01.2", "1.0010"]
    df = spark.createDataFrame([("p", v) for v in versions], "pkg string, version string")
    assert packages.latest_version(df, ["pkg"], order="numeric").first().latest == "1.1" + "0" * 40
    df = spark.createDataFrame([(5 * 10**14, 3), (9223372036854775807, 9223372036854775807), (1, 0)], "a bigint, b bigint")
    got = [r[0] for r in df.select(numbers.percent_2dp(F.col("a"), F.col("b")).cast("decimal(38,2)").cast("string")).collect()]
    assert got == ["16666666666666666.67", "100.00", None]


def test_lock_lines(spark):
    df = spark.createDataFrame([("    name (1.0)",), ("  * star",), ("* top",), ("*tight",), ("",), ("    bare",)], "line string")
    assert [r.name for r in filters.lock_names(df).collect()] == ["*", "*", "*tight"]
    assert [r.name for r in filters.lock_names(df, mode="indented").collect()] == ["star", "top", "tight", "bare"]


def test_projects_pass_by_default(spark):
    df = spark.createDataFrame([("a", 5), ("a", 6), ("b", 1)], "project string, size int")
    assert rows(filters.select_projects(df, "project", "size"), "project") == [("a", 11), ("b", 1)]
    block = spark.createDataFrame([("b",)], "project string")
    assert filters.select_projects(df, "project", "size", block=block, max_size=10).isEmpty()


# --- numbering ---


def test_numbers_over_a_hot_group(spark):
    random.seed(1)
    data = [("hot" if i % 3 else f"g{i % 50}", i) for i in range(3000)] + [(None, -1), (None, -2)]
    random.shuffle(data)
    df = spark.createDataFrame(data, "g string, k long").repartition(7)
    got = numbering.number_rows(df, ["k"], ["g"], total="n")
    want = []
    for group in {g for g, _ in data}:
        keys = sorted(k for g, k in data if g == group)
        want += [(group, k, i + 1, len(keys)) for i, k in enumerate(keys)]
    key = lambda r: (str(r[0]), r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_pages_fill_up(spark):
    df = spark.createDataFrame([(i * 7 % 1009,) for i in range(1009)], "k long")
    pages = [r[1] for r in rows(numbering.paginate(df, "k", 100).groupBy("page").count(), "page")]
    assert pages == [100] * 10 + [9]
    kept = numbering.page_budget(numbering.paginate(df, "k", 100), "page", 2)
    assert sorted(r.k for r in kept.collect()) == list(range(200))
    assert numbering.page_budget(df, "k", 0) is df


def test_numbering_never_uses_one_task_for_all_rows(spark, capsys):
    df = spark.range(100).withColumnRenamed("id", "k")
    numbering.paginate(df, "k", 10).explain()
    plan = capsys.readouterr().out
    lines = plan.splitlines()
    # only aggregates are brought together: minima and maxima, and the counts of cells
    assert all("Aggregate" in lines[i + 1] for i, line in enumerate(lines) if "SinglePartition" in line)
    assert "BroadcastHashJoin" in plan


def test_building_a_numbered_frame_runs_nothing(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("k"), (F.col("id") % 3).alias("g"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("numbering", "nothing")
    frames = [numbering.number_rows(df, ["k"], total="n"), numbering.paginate(df, "k", 10), numbering.progress(df, "g", ["k"])]
    assert not tracker.getJobIdsForGroup("numbering")
    assert [f.count() for f in frames] == [1000] * 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


KINDS = {
    "long": [None, None, -(1 << 63), -5, 0, 1, 2, 3, (1 << 63) - 1],
    "int": [7, 7, 7, None, -2],
    "string": [None, "", "a", "a\u0000", "a\u0000b", "ab", "https://x/1", "https://x/10", "https://x/2", "ü", "\U0001f600", "z" * 999, "z" * 998 + "a"],
    "date": [None, datetime.date(1, 1, 1), datetime.date(1969, 12, 31), datetime.date(1970, 1, 1), datetime.date(9999, 12, 31)],
    "boolean": [True, False, None, True],
    "double": [1.5, -2.0, None, 7.0],
    "decimal(10,2)": [decimal.Decimal("1.50"), decimal.Decimal("-3.00"), None],
}


@pytest.mark.parametrize("kind", KINDS)
def test_numbers_for_keys_of_any_type(spark, kind):
    values = [(v, i) for i, v in enumerate(KINDS[kind] * 3)]
    random.Random(3).shuffle(values)
    df = spark.createDataFrame(values, f"v {kind}, i long").repartition(5)
    got = [(r.v, r.i) for r in numbering.number_rows(df, ["v", "i"]).orderBy("rn").collect()]
    assert got == [(r.v, r.i) for r in df.orderBy("v", "i").collect()]


def test_numbers_by_a_struct_and_in_one_crowded_place(spark):
    """All keys but two lie close together: the second level divides them."""
    far = spark.createDataFrame([(-(10**15),), (10**15,)], "k long")
    df = far.union(spark.range(20_000)).select(F.struct(F.col("k"), F.lit("x").alias("t")).alias("v"))
    got = numbering.number_rows(df, [F.col("v")])
    assert got.filter("rn <> v.k + 2 and abs(v.k) < 1e15").isEmpty() and got.count() == 20_002
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "_fine" in plan


# --- packages ---


def test_top_versions_limit_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([("p", f"1.{i}.0") for i in range(40)] + [("p", "bad"), ("q", "1.0.0-rc.1"), ("q", "1.0.0")], "pkg string, version string")
    got = packages.top_versions(df.union(df), 3)
    assert rows(got, "pkg", "rank") == [("p", "1.39.0", 1), ("p", "1.38.0", 2), ("p", "1.37.0", 3), ("q", "1.0.0", 1), ("q", "1.0.0-rc.1", 2)]
    got.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
    good, bad = packages.split_versions(df)
    assert (good.count(), bad.count()) == (42, 1)


def test_latest_by_text_and_by_number(spark):
    df = spark.createDataFrame([("g", v) for v in ("9.0", "10.0", "10.0-rc", "x")], "k string, version string")
    assert rows(packages.latest_version(df, ["k"])) == [("g", "9.0")]
    assert rows(packages.latest_version(df, ["k"], order="numeric")) == [("g", "10.0")]


def test_version_check_without_a_listing(spark):
    current = spark.createDataFrame([("g", "a", "1.0"), ("g", "b", "1.0")], "group_id string, artifact_id string, latest_version string")
    latest = spark.createDataFrame([("g", "a", "1.1")], "group_id string, artifact_id string, latest string")
    checked = packages.check_versions(current, latest, ["group_id", "artifact_id"])
    assert rows(checked, "artifact_id") == [("g", "a", "1.0", "1.1", True), ("g", "b", "1.0", "1.0", False)]
    assert rows(packages.version_changes(checked, ["group_id", "artifact_id"])) == [("g", "a", "1.0", "1.1")]


# --- snapshots ---


def counts(spark, data):
    return spark.createDataFrame(data, "snapshot string, query string, n long")


def test_diff_statuses_and_order(spark):
    data = [("2024-01-01", q, n) for q, n in [("same", 5), ("up", 100), ("down", 80), ("failed", None), ("gone", 1), ("zero", 0)]]
    data += [("2024-01-02", q, n) for q, n in [("same", 5), ("up", 101), ("down", 60), ("failed", 7), ("nulled", None), ("fresh", 9), ("zero", 4)]]
    data += [("2023-12-31", "up", 1)]
    got = snapshots.snapshot_diff(counts(spark, data)).collect()
    assert [(r.query, r.status, r["diff"], r.percentage) for r in got] == [
        ("down", "changed", -20, "-25.00"), ("zero", "changed", 4, None), ("up", "changed", 1, "1.00"),
        ("fresh", "new", None, None), ("failed", "error", None, None), ("nulled", "error", None, None),
    ]
    lines = {r.query: r.line for r in snapshots.display_line(snapshots.snapshot_diff(counts(spark, data))).collect()}
    assert lines["down"] == "down: 80 → 60 (-20, -25.00%)" and lines["up"] == "up: 100 → 101 (+1, 1.00%)"


def test_one_snapshot_is_not_enough(spark):
    with pytest.raises(Exception, match="two snapshots"):
        snapshots.snapshot_diff(counts(spark, [("2024-01-01", "a", 1)])).collect()


# --- enrichment, plans, search ---


def test_overlay_keeps_old_values_and_rows_without_key(spark):
    base = spark.createDataFrame([("1", "old", "o@x"), ("", "none", None), (None, "nil", None), ("2", "keep", None)], "inn string, name string, email string")
    found = spark.createDataFrame([("1", "new", None, "7"), ("", "wrong", "w", "w")], "inn string, name string, email string, phone string")
    got = enrich.overlay(base, found, "inn", ["name", "email", "phone"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [("1", "new", "o@x", "7"), ("", "none", None, None), (None, "nil", None, None), ("2", "keep", None, None)], key=str
    )


def test_upsert_by_position_and_by_key(spark):
    old = spark.createDataFrame([(0, "a", "x"), (1, "b", "y")], "pos int, inn string, name string")
    new = spark.createDataFrame([(0, "b", None, 1), (2, "c", "z", 2)], "pos int, inn string, name string, extra int")
    assert rows(enrich.upsert(old, new, "pos"), "pos") == [(0, "b", "x", 1), (1, "b", "y", None), (2, "c", "z", 2)]
    by_inn = enrich.upsert(old.drop("pos"), new.drop("pos"), "inn")
    assert rows(by_inn, "inn") == [("a", "x", None), ("b", "y", 1), ("c", "z", 2)]


def test_fetch_states(spark):
    plan = spark.createDataFrame([(p,) for p in "abcde"], "path string")
    index = spark.createDataFrame([(p, 10) for p in "abcd"], "path string, size long")
    local = spark.createDataFrame([("b", 10), ("c", 4), ("d", 11), ("e", 1)], "path string, size long")
    got = fetchplan.fetch_state(plan, index, local).select("path", "state", "resume_from")
    assert rows(got, "path") == [("a", "full", 0), ("b", "complete", None), ("c", "resume", 4), ("d", "oversize", 0), ("e", "missing", None)]


def test_artifact_needs_jar_and_pom(spark):
    artifacts = spark.createDataFrame([("o.g", a, "1:0") for a in "xyz"], "group_id string, artifact_id string, latest_version string")
    have = [("maven2/o/g/x/1_0/x-1_0.jar",), ("maven2/o/g/x/1_0/x-1_0.pom",), ("maven2/o/g/y/1_0/y-1_0-sources.jar",), ("maven2/o/g/y/1_0/y-1_0.pom",)]
    got = fetchplan.complete_artifacts(artifacts, spark.createDataFrame(have, "path string"))
    assert rows(got.select("artifact_id", "complete"), "artifact_id") == [("x", True), ("y", False), ("z", False)]


def test_scoped_names(spark):
    pairs = spark.createDataFrame([("@s/n", "1.0.0")], "pkg string, version string")
    assert fetchplan.npm_plan(pairs).first().url == "https://registry.npmjs.org/@s/n/-/@s/n-1.0.0.tgz"
    assert fetchplan.npm_plan(pairs, scoped="registry").first().url == "https://registry.npmjs.org/@s/n/-/n-1.0.0.tgz"


def test_terms(spark):
    df = spark.createDataFrame([(1, "A React app, react!"), (2, "nothing"), (3, "ui-kit API")], "id int, t string")
    assert rows(search.term_hits(df, "t").select("id", "query"), "id", "query") == [(1, "app"), (1, "react"), (3, "api"), (3, "ui")]
    tally = dict(rows(search.term_counts(df, "t", ["react", "api", "zzz"])))
    assert tally == {"react": 1, "api": 1, "zzz": 0}
    assert len(search.SEARCH_TERMS) == len(set(search.SEARCH_TERMS))


def test_reconcile_lists_on_one_side(spark):
    want = spark.createDataFrame([("a",), ("a",), ("b",)], "list string")
    have = spark.createDataFrame([("a",), ("c",)], "list string")
    got = rows(reconcile.reconcile(want, have).filter("is_total = 0"), "list")
    assert got == [("a", 2, 1, 0, 1, False), ("b", 1, 0, 0, 1, False), ("c", 0, 1, 0, -1, False)]
    total = reconcile.reconcile(want, have).filter("is_total = 1").first()
    assert (total.expected, total.actual, total.difference) == (3, 2, 1)
