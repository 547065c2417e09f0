import re

import pytest
from pyspark.sql import functions as F

from listprep.llm import exact
from tests.llm import helpers as h


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_odd_rows(spark):
    docs = h.frame(spark, h.ODD, extra=True)
    assert h.rows(exact.deduplicate(docs)) == h.exact(pairs(docs))


def test_empty_table(spark):
    docs = h.frame(spark, [])
    assert exact.deduplicate(docs).count() == 0
    assert exact.kept_documents(docs).columns == docs.columns


def test_equal_digests_of_different_texts_are_told_apart(spark):
    texts = [f"text {n % 7}" for n in range(40)] + ["text  3", "longer text", None]
    docs = h.frame(spark, texts)
    got = exact.deduplicate(docs, digest=lambda t: F.length(t).cast("string"))
    assert h.rows(got) == h.exact(pairs(docs))


def test_hot_group_is_compared_in_slices(spark):
    docs = h.frame(spark, ["same text"] * 1500 + [f"own {n}" for n in range(50)])
    assert h.rows(exact.deduplicate(docs)) == h.exact(pairs(docs))
    copies = docs.select("doc_id", "text", F.lit("d").alias("digest"), F.lit(0).alias("keep_id"),
                         F.lit(1550).cast("long").alias("group_size"))
    assert exact.differing(copies, slice_rows=10).count() == 1


def test_stream_goes_on_with_its_state(spark, tmp_path):
    source, state, out = (str(tmp_path / x) for x in ("in", "state", "out"))
    for part in ([(5, "a"), (3, "c c")], [(0, "a"), (4, "b")], [(1, "b"), (2, "c\tc")]):
        docs = spark.createDataFrame(part, "doc_id long, text string")
        exact.signatures(docs).write.mode("append").parquet(source)
        exact.run_stream(spark, source, state, out)
    exact.run_stream(spark, source, state, out)  # nothing new
    got = {(r.keep_id, r.group_size) for r in exact.newest(spark, out).collect()}
    assert got == {(0, 2), (1, 2), (2, 2)}


def test_kept_documents(spark):
    docs = h.frame(spark, h.ODD, extra=True)
    kept = exact.kept_documents(docs)
    assert kept.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in pairs(kept)]
    assert set(texts) == {re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in pairs(docs)}
    # only rows that repeat doc_id and text share a flag
    assert len(texts) - len(set(texts)) == 0 or {t for t in texts if texts.count(t) > 1} <= {"one"}


@pytest.mark.parametrize("name", ["op3_exact_dedup"])
def test_query(spark, folder, name):
    from listprep.llm.registry import QUERIES

    got = QUERIES[name](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert h.rows(got) == h.exact(pairs(docs))
