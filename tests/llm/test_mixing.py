import hashlib

import pytest
from pyspark.sql import functions as F

from listprep.llm import mixing
from tests.llm import helpers as h


def brute(docs, weights=(5, 2, 1), percent=150, epochs=2):
    """Targets by sharing the excess again and again; documents in key order."""
    rows = [(d, s, len(h.ws_words(t)), hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()) for d, t, s in docs]
    names = sorted({s for _, s, _, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, x, n, _ in rows if x == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        left = sum(size.values()) * percent / 100 - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > epochs * size[s]]
        if not above:
            target |= share
            break
        for s in above:
            target[s] = float(epochs * size[s])
            open_.discard(s)
    out = {}
    for s in names:
        budget = int(target[s] + 1e-9)
        passes = budget // max(size[s], 1)
        rest = budget - passes * size[s]
        for d, _, n, _ in sorted((r for r in rows if r[1] == s), key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[2])):
            take = max(0, min(n, rest))
            rest -= take
            out.setdefault((d, s, n), []).append(n * passes + take)
    return target, {k: sorted(v) for k, v in out.items()}


def check(df, docs):
    target, taken = brute([tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    got = {}
    for r in df.collect():
        assert r.target == pytest.approx(target[r.source], rel=1e-9)
        got.setdefault((r.doc_id, r.source, r["size"]), []).append(r.taken)
    assert {k: sorted(v) for k, v in got.items()} == taken


def test_odd_rows(spark):
    docs = h.frame(spark, h.ODD, extra=True)
    check(mixing.mix(docs), docs)


def test_empty_tables(spark):
    for texts in ([], [None, "", " "]):
        docs = h.frame(spark, texts)
        assert mixing.mix(docs).count() == len(texts)
        assert mixing.mixed_documents(docs).count() == 0


def test_hot_source(spark):
    texts = [(n, "w " * (n % 17), "hot" if n % 3 else f"s{n % 7}") for n in range(3000)]
    docs = h.frame(spark, texts)
    got = mixing.mix(docs)
    check(got, docs)
    sums = got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(0 <= r.g - r.t < 1 for r in sums)
    assert got.filter("taken > 2 * size").count() == 0
    assert h.rows(got) == h.rows(mixing.mix(docs.repartition(5)))


def test_mixed_documents(spark):
    docs = h.frame(spark, [(n, "w " * (n % 17), f"s{n % 4}") for n in range(400)], extra=True)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    sizes = got.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert abs(sizes - sum(n % 17 for n in range(400)) * 1.5) < 4 * 17
    assert got.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
