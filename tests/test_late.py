"""Wide columns are read late: exact results, and no page text in a shuffle."""

import pytest
from pyspark.sql import functions as F

from listprep.functions import text
from listprep.operators import joins, membership
from listprep.operators.late import maybe_in
from listprep.plans import catalog, procurement
from listprep.queries import load
from tests.test_scale import executed_plan, small_thresholds  # noqa: F401


@pytest.mark.parametrize("wanted,most", [(0, 2048), (1, 2048), (9000, 2048), (9000, 1)])
def test_no_wanted_row_is_lost_and_few_others_pass(spark, wanted, most):
    rows = spark.range(30_000).select(F.concat(F.lit("u"), "id").alias("url"), F.col("id").alias("n"))
    keys = rows.filter(F.col("n") < wanted).select("url").union(spark.createDataFrame([(None,)], "url string"))
    got = rows.union(spark.createDataFrame([(None, -1)], "url string, n long")).filter(maybe_in(F.col("url"), keys, "url", most))
    assert got.filter(F.col("n").between(0, wanted - 1)).count() == wanted and got.filter("n = -1").count() == 0
    if most > 1:
        assert got.count() - wanted < 0.03 * 30_000


def test_bitmaps_stand_once_in_a_filter(spark):
    """They go to the tasks with the plan, by way of the driver, once for each time they are written."""
    rows = spark.range(100).select(F.concat(F.lit("u"), "id").alias("url"))
    plan = rows.filter(maybe_in(F.col("url"), rows.limit(10), "url"))._jdf.queryExecution().analyzed().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "scalar-subquery" in line]
    # the bitmaps, and how many there are
    assert len(filters) == 1 and filters[0].count("scalar-subquery#") == 2, filters


def pages(spark, n=400):
    html = F.concat(F.lit("<html><body><div class='mw-parser-output'><p>page "), F.col("id").cast("string"), F.lit("</p>"), F.repeat(F.lit("<p>text</p>"), 50), F.lit("</div></body></html>"))
    return spark.range(n).select(F.concat(F.lit("u"), "id").alias("url"), html.alias("html"))


def exchanges(df, kind="Exchange"):
    """Columns of every exchange of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in name:
            walk(node.plan())
        else:
            if kind in name:
                found.append([node.output().apply(i).name() for i in range(node.output().size())])
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))

    walk(plan)
    return found


def test_contract_pages_are_not_shuffled(spark, small_thresholds, folder):  # noqa: F811
    table = pages(spark).withColumnRenamed("url", "link")
    stored = table.filter(F.col("link").endswith("7")).select("link")
    got = procurement.contract_rows(table, stored)
    columns = exchanges(got)
    assert columns and not any(c in ("html", "doc", "nodes", "text") for names in columns for c in names), columns
    assert got.count() == 360 and got.filter(F.col("link").endswith("7")).count() == 0


def test_wiki_pages_are_not_shuffled(spark, small_thresholds):  # noqa: F811
    table = pages(spark)
    links = table.select(F.lit("l").alias("list"), F.substring("url", 2, 9).cast("long").alias("pos"), F.col("url").alias("title"), "url")
    outputs = links.filter("pos % 4 = 0").select("list", F.lit(None).cast("string").alias("safe_name"), "url", F.lit(False).alias("has_error"))
    got = catalog.pending_records(links, outputs, table).select("list", "pos", "title", "error")
    columns = exchanges(got)
    assert columns and not any("html" in c or c in ("doc", "nodes") for names in columns for c in names), columns
    assert sorted(r.pos for r in got.collect()) == [n for n in range(400) if n % 4]


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_wiki_records_are_never_broadcast(spark, monkeypatch, tmp_path, most):
    """Page records are far larger than the compressed pages read, by whose size Spark would send them to the driver."""
    monkeypatch.setattr(joins, "SENT_BYTES", most, raising=False)
    pages(spark).write.parquet(f"{tmp_path}/pages")
    table = spark.read.parquet(f"{tmp_path}/pages")
    links = table.select(F.lit("l").alias("list"), F.substring("url", 2, 9).cast("long").alias("pos"), F.col("url").alias("title"), "url")
    outputs = links.filter("pos % 4 = 0").select("list", F.lit(None).cast("string").alias("safe_name"), "url", F.lit(False).alias("has_error"))
    got = catalog.pending_records(links, outputs, table)
    sent = [columns for columns in exchanges(got) if "list_title" in columns or "raw_html" in columns]
    joined = "BroadcastHashJoin" if most else "SortMergeJoin"
    assert joined in got._jdf.queryExecution().executedPlan().toString()
    # both sides are dealt out by the key, or the pending links alone are sent
    assert len(sent) == (1 if most else 2) and (not most or "raw_html" not in sent[0])
    rows = got.collect()
    assert sorted(r.pos for r in rows) == [n for n in range(400) if n % 4] and all(r.title == f"u{r.pos}" for r in rows)


def test_names_of_links_are_never_broadcast(spark, tmp_path):
    """Three names for each link are far larger than the compressed file they come from."""
    title = F.concat(F.repeat(F.lit("Name: of a page / "), 4), F.col("id").cast("string"))
    spark.range(20_000).select(F.lit("l").alias("list"), F.col("id").alias("pos"), title.alias("title"), F.concat(F.lit("u"), "id").alias("url")).write.parquet(f"{tmp_path}/links")
    links = spark.read.parquet(f"{tmp_path}/links")
    done = links.filter("pos % 3 = 0").select("list", text.safe_title(F.col("title"), F.col("pos")).alias("safe_name"), (F.col("pos") % 2 == 0).alias("has_error"))
    got = membership.pending_or_failed(links, done)
    # names are dealt out by name
    assert not [names for names in exchanges(got, "BroadcastExchange") if "safe_name" in names]
    assert sorted(r.pos for r in got.collect()) == [n for n in range(20_000) if n % 3 or n % 2 == 0]


def test_stored_keys_are_sent_within_the_threshold_only(spark, small_thresholds):  # noqa: F811
    stored = spark.range(5).select(F.concat(F.lit("u"), "id").alias("url"), F.col("id").alias("pos"))
    got = joins.join_stored(pages(spark, 9), stored, ["url"])
    assert "SortMergeJoin" in executed_plan(got) and sorted(r.pos for r in got.collect()) == [0, 1, 2, 3, 4]


def test_null_keys_stay_pending(spark):
    table = pages(spark, 3).withColumnRenamed("url", "link").union(pages(spark, 1).select(F.lit(None).cast("string"), "html"))
    assert procurement.contract_rows(table, table.limit(0).select("link")).count() == 4


def test_queries_of_the_plans(spark, folder):
    for name in ("contract_report", "wiki_catalog"):
        assert load().QUERIES[name](spark, folder).count() > 0
