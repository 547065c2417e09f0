"""The stored key index: exact answers, flat cost per batch, replays and lost drivers."""

import os

import pytest
from pyspark.sql import functions as F

from listprep.operators.keyindex import KeyIndex, bit_at, placed_keys, probes, unknown_rows
from listprep.streaming import jobs


def keys(spark, start, stop):
    return spark.range(start, stop, 1, 4).select(F.concat(F.lit("https://a.example.org/"), "id").alias("key"))


def fill(index, df):
    state = index.manifest()
    index.add(state, df, df.count())
    index.commit(state)


class Measured(KeyIndex):
    """Counts the bytes of the files it opens."""

    seen = 0

    def _read(self, segment, kind, schema, buckets=None):
        folder = self._folder(segment, kind)
        wanted = [folder] if buckets is None else [f"{folder}/bucket={b}" for b in buckets]
        self.seen += sum(os.path.getsize(os.path.join(d, f)) for top in wanted for d, _, names in os.walk(top) for f in names if f.endswith(".parquet"))
        return super()._read(segment, kind, schema, buckets)


def test_answers_are_exact(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), bucket_keys=300, fan=3)
    assert index.known(keys(spark, 0, 10)).count() == 0
    for n in range(5):
        fill(index, keys(spark, n * 1000, n * 1000 + 700 + n))
    assert len(index.manifest()["segments"]) < 5
    asked = keys(spark, 500, 6000).union(spark.createDataFrame([("",), ("ü",)], "key string")).distinct()
    want = {r.key for n in range(5) for r in keys(spark, max(500, n * 1000), n * 1000 + 700 + n).collect()}
    assert {r.key for r in index.known(asked).collect()} == want


def test_bits_of_held_keys_are_all_set(spark):
    placed = placed_keys(keys(spark, 0, 5000), 1, 2)
    bits = placed.select("block", F.explode(probes(F.col("hash"))).alias("b")).groupBy("block").agg(F.bitmap_construct_agg("b").alias("bits"))
    test = lambda df: df.join(bits, "block").filter(F.forall(probes(F.col("hash")), lambda p: bit_at(F.col("bits"), p))).count()
    assert test(placed) == 5000
    assert test(placed_keys(keys(spark, 10_000, 15_000), 1, 2)) < 250


def test_a_batch_reads_no_more_when_the_list_is_ten_times_as_long(spark, tmp_path):
    """Batches of ten new and ten old keys; bytes of all files opened for the look-up."""
    read = {}
    for size in (3000, 30_000):
        index = Measured(spark, str(tmp_path / f"i{size}"), bucket_keys=100)
        fill(index, keys(spark, 0, size))
        index.seen = 0
        batch = keys(spark, size - 10, size + 10)
        assert index.known(batch).count() == 10
        read[size] = index.seen
        whole = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(tmp_path / f"i{size}") for f in names)
        assert index.seen < whole / (2 if size == 3000 else 20)
    assert read[30_000] < 1.5 * read[3000]


def test_segments_stay_few(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), bucket_keys=1000, fan=3)
    for n in range(12):
        fill(index, keys(spark, n * 20, n * 20 + 20))
    state = index.manifest()
    assert sum(s["rows"] for s in state["segments"]) == 240 and len(state["segments"]) <= 6
    assert index.known(keys(spark, 0, 400)).count() == 240


def batch_of(spark, *urls):
    return spark.createDataFrame([(u, n) for n, u in enumerate(urls)], "url string, pos long")


def stored(spark, target):
    return sorted(r.url for r in spark.read.parquet(target).select("url").collect())


def test_replays_and_lost_drivers(spark, tmp_path):
    target = str(tmp_path / "t")
    index = jobs.link_index(spark, target, bucket_keys=10)
    jobs.append_batch(index, target, batch_of(spark, "a", "b", "a", None), "r1", 0)
    jobs.append_batch(index, target, batch_of(spark, "b", "c"), "r1", 1)
    jobs.append_batch(index, target, batch_of(spark, "b", "c"), "r1", 1)
    jobs.append_batch(index, target, batch_of(spark, "a", "b"), "r1", 0)
    assert stored(spark, target) == ["a", "b", "c"]
    # the driver died after the output, before the index: another run must know the keys
    state = index.manifest()
    state["pending"] = ["r1", 2]
    index.commit(state)
    batch_of(spark, "d").write.parquet(f"{target}/run=r1/batch=2")
    jobs.append_batch(index, target, batch_of(spark, "d", "e"), "r2", 0)
    assert stored(spark, target) == ["a", "b", "c", "d", "e"]
    # it died before the output was whole: the same batch is done again
    state = index.manifest()
    state["pending"] = ["r2", 1]
    index.commit(state)
    jobs.append_batch(index, target, batch_of(spark, "e", "f"), "r2", 1)
    assert stored(spark, target) == ["a", "b", "c", "d", "e", "f"]


def test_a_list_stored_without_an_index_is_taken_in(spark, tmp_path):
    target = str(tmp_path / "t")
    batch_of(spark, "a", "b").write.parquet(f"{target}/run=0/batch=0")
    jobs.append_batch(jobs.link_index(spark, target), target, batch_of(spark, "b", "c"), "1", 0)
    assert stored(spark, target) == ["a", "b", "c"]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_keys_of_other_types(spark, tmp_path, kind):
    index = KeyIndex(spark, str(tmp_path / "i"))
    fill(index, spark.range(5).select(F.col("id").cast("string").alias("key")))
    batch = spark.range(3, 9).select(F.col("id").cast(kind).alias("k"), F.col("id").alias("pos"))
    got = unknown_rows(batch, index, "k", ["pos"])
    assert got.schema["k"].dataType.typeName() == kind.replace("long", "long") and got.count() == 4
