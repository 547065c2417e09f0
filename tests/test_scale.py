"""Plans and hot keys: what must hold when one key has a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from listprep import session
from listprep.operators import enrich, membership, packages
from listprep.queries import load

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_thresholds(spark):
    """Skew handling starts at some kilobytes instead of hundreds of megabytes."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark, n=30_000):
    """Two thirds of the rows have one key."""
    key = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    return spark.range(n).repartition(8).select("id", key.alias("inn"), F.sha2(F.col("id").cast("string"), 256).alias("name"))


def test_hot_key_of_an_overlay_is_split(spark, small_thresholds):
    base = hot_rows(spark)
    found = base.select("inn").distinct().withColumn("phone", F.concat(F.lit("t"), "inn"))
    got = enrich.overlay(base, found, "inn", ["phone"])
    assert "skew=true" in executed_plan(got)
    assert got.filter("phone = concat('t', inn)").count() == 30_000


def test_hot_key_of_an_exclusion_is_split(spark, small_thresholds):
    known = spark.createDataFrame([("k1",), ("k2",)], "inn string")
    got = membership.without_known(hot_rows(spark), known, ["inn"])
    assert "skew=true" in executed_plan(got)
    assert got.filter("inn = 'hot'").count() == 20_000


def test_rows_without_a_key_do_not_meet_in_one_task(spark):
    base = hot_rows(spark).withColumn("inn", F.when(F.col("inn") != "hot", F.col("inn")).otherwise(""))
    spread = enrich.overlay(base, base.select("inn").distinct().withColumn("phone", F.lit("t")), "inn", ["phone"])
    assert spread.filter("inn = '' and phone is null").count() == 20_000
    blank = F.concat(F.lit("\u0000"), F.xxhash64("id", "inn", "name").cast("string"))
    sizes = [r["count"] for r in base.filter("inn = ''").repartition(8, blank).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 20_000 / 8


def test_first_rows_shrink_before_the_shuffle(spark):
    plan = executed_plan(membership.first_rows(hot_rows(spark), ["inn"], ["id"]))
    assert "partial_min_by" in plan


def test_versions_are_limited_before_the_shuffle(spark):
    versions = hot_rows(spark).select(F.col("inn").alias("pkg"), F.concat(F.lit("1.0."), "id").alias("version"))
    got = packages.top_versions(versions, 5)
    assert executed_plan(got).count("WindowGroupLimit") >= 2
    assert [r.version for r in got.filter("pkg = 'hot'").orderBy("rank").collect()] == [f"1.0.{i}" for i in (29999, 29998, 29996, 29995, 29993)]


def test_no_cross_join_and_no_unbounded_broadcast(spark, folder, small_thresholds):
    """With automatic broadcasts off, only sides of proven size are broadcast."""
    allowed = {"keyset_pages", "page_budget", "semver_sort", "snapshot_diff", "stored_diff"}
    for name, query in load().QUERIES.items():
        if name.startswith(("stream_", "snk_", "src_", "save_list")):
            continue  # these run inside
        plan = query(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert name in allowed or "BroadcastHashJoin" not in plan, name


def test_scans_read_only_what_is_needed(spark, folder):
    queries = load().QUERIES

    def read(name):
        return queries[name](spark, folder)._jdf.queryExecution().executedPlan().toString()

    assert "html" not in read("absolute_urls")
    assert "text" not in read("progress_pct").replace("Context", "")
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual(o_totalprice,100000.0)]" in read("price_floor_page")


def test_shuffle_partitions_follow_the_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session.tune(spark, shuffle_bytes=100 << 40)
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(100 << 13)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "yarn"
        applicationId = "a"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
