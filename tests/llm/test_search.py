"""Ranked search against a plain ranking of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from listprep.llm import search
from tests.llm import helpers as h

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, best=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    total = sum(1 for _, b in bags if b)
    length = sum(sum(b.values()) for _, b in bags)
    out = []
    for item, text in set(items):
        scored = []
        for d, bag in bags:
            m = 10 + (90 * sum(bag.values()) * total) // max(length, 1)
            score = 0
            for t in set(terms(text)):
                df = sum(1 for _, b in bags if t in b)
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
                score += w * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scored)[:best], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=h.key)


ITEMS = [(1, "one text"), (1, "one text"), (1, "two"), (2, "ÜNÏ lorem MIT"), (3, ""), (4, None), (5, "nowhere"), (None, "one")]


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS score", "1 AS rank", "2 AS doc_id")


@pytest.mark.parametrize("block", [1, 3, 50_000])
def test_odd_rows(spark, block):
    docs = h.frame(spark, h.ODD, extra=True).selectExpr("*", "'x' AS terms", "'x' AS counts", "0 AS n", "7 AS item_id")
    got = search.search(docs, items_of(spark, ITEMS), block_terms=block)
    assert h.rows(got) == brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS)


def test_ties_and_many_equal_rows(spark):
    texts = ["same words here"] * 40 + [(None, "same words here", "s")] + ["other words"] * 3
    docs = h.frame(spark, texts).repartition(7)
    got = search.search(docs, items_of(spark, [(9, "same words"), (8, "here other")]))
    assert h.rows(got) == brute([(r.doc_id, r.text) for r in docs.collect()], [(9, "same words"), (8, "here other")])


def test_empty_tables(spark):
    none = h.frame(spark, [])
    some = h.frame(spark, [None, "", "one"])
    assert search.search(none, items_of(spark, ITEMS)).count() == 0
    assert search.search(some, items_of(spark, [])).count() == 0
    assert search.search(some.filter("text is null"), items_of(spark, ITEMS)).count() == 0


def batch(rng, docs, words):
    terms_, counts, ends = [], [], [0]
    for _ in range(docs):
        own = np.unique(np.minimum(rng.zipf(1.3, rng.integers(0, 60)), words) - 1)
        terms_ += own.tolist()
        counts += rng.integers(1, 9, len(own)).tolist()
        ends.append(len(terms_))
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (terms_, counts)]
    ids = pa.array(rng.permutation(docs).tolist(), pa.int64())
    return pa.RecordBatch.from_arrays([ids, pa.array(rng.integers(60, 400, docs)), *lists], names=["doc_id", "n", "terms", "counts"])


@pytest.mark.parametrize("short,step", [(0, 1), (0, 64), (50, 8), (300, 64), (10**9, 64)])
def test_walk_gives_the_best_and_skips(short, step):
    """Any split between accumulators and long lists has the same result; long lists aren't walked whole."""
    rng = np.random.default_rng(short + step)
    data = batch(rng, 4000, 80)
    segment = search.Segment(data, 4000, 900_000)
    rows = data.to_pylist()
    weights = [search.weight(4000, sum(t in r["terms"] for r in rows)) for t in range(80)]
    for items in ([0, 1, 2, 5, 17, 40], [3], [0, 79, 60], [77, 78, 79]):
        top = search.Top.empty(10)
        visited = segment.walk(items, [weights[t] for t in items], top, short, step)
        want = []
        for r in rows:
            m = 10 + (90 * r["n"] * 4000) // 900_000
            tf = dict(zip(r["terms"], r["counts"], strict=True))
            score = sum(weights[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in items if t in tf)
            want.append((-score, r["doc_id"]))
        want = [(-s, d) for s, d in sorted(want)[:10] if s]
        assert list(zip(top.scores.tolist(), top.ids.tolist(), strict=True)) == want
        holding = sum(any(t in r["terms"] for t in items) for r in rows)
        assert visited <= holding
        if items == [0, 79, 60] and short in (0, 50):
            assert visited < holding / 2
