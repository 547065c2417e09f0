import zlib

import numpy as np
import pyarrow as pa
import pytest

from listprep.llm import classifier
from tests.llm import helpers as h


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    _, inverse, counts = np.unique(scores, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    n1 = labels.sum()
    n0 = len(labels) - n1
    assert len(order)
    return (rank[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n0 * n1)


def test_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 5))
    y = np.sign(x @ np.array([1, -2, 0.5, 0, 0]) + 0.3 * rng.normal(size=80))
    rows = [(np.arange(5), v) for v in x]
    w, b = classifier.descend(rows, y, 5, rounds=3000, tolerance=1e-6)
    share = {c: (y == c).sum() for c in (-1.0, 1.0)}
    cost = np.array([len(y) / (2 * share[c]) for c in y])

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - y * (x @ w + b))).sum()

    best = loss(w, b)
    for _ in range(2000):
        assert loss(w + rng.normal(size=5) * 0.02, b + rng.normal() * 0.02) >= best - 1e-3


def test_grams_are_those_of_a_plain_walk():
    texts = ["Ab ab ab! cd", "", None, "x\n\ny 12 x", "AB*** CD***"]
    both = classifier.gram_sets(pa.array(texts))
    alone = [classifier.gram_sets(pa.array([t]))[0] for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(both, alone, strict=True))
    assert len(both[1]) == len(both[2]) == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_held_out_rows(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = classifier.quality_classifier(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out]
    labels = np.array([r.quality for r in out])
    assert auc(np.array([r.score for r in out]), labels) > 0.95
    right = np.array([r.predicted for r in out])
    assert right[labels == 1].mean() >= 0.99
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_odd_rows(spark):
    docs = h.frame(spark, [*h.ODD, *["good clean words here"] * 30, *["BAD!! BAD!! BAD!!"] * 30], extra=True)
    labels = spark.createDataFrame(
        [(n, int(n < 46), 0) for n in range(16, 76)] + [(None, 1, 1), (9999, 0, 0), (20, None, None), (20, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = classifier.classify(docs, labels)
    assert got.count() == docs.count()
    by = {r.doc_id: r for r in got.collect()}
    assert by[25].score > 0.7 and by[70].score < 0.3
    kept = classifier.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.filter("text LIKE 'BAD%'").count() == 0
    assert classifier.classify(h.frame(spark, []), labels).count() == 0
    assert {r.score for r in classifier.classify(docs, labels.limit(0)).collect()} == {0.5}
