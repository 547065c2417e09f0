import hashlib

import numpy as np

import corpus_pipeline
from listprep.llm import bpe, classifier
from tests.llm import helpers as h
from tests.llm.test_bpe import PLAIN
from tests.llm.test_mixing import brute as mix_brute
from tests.llm.test_simhash import brute as near_brute


def mixed(docs):
    """Rows of the mix by brute force."""
    _, taken = mix_brute([(d, t, s) for d, t, s, _ in docs])
    out = []
    for d, t, s, lang in docs:
        size = len(h.ws_words(t))
        if size:
            out += [(d, t, s, lang)] * int((taken[(d, s, size)][0] + size // 2) // size)
    return out


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, folder)
    accepted = {r.doc_id for r in classifier.classify(docs, labels).filter("predicted = 1").collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect() if r.doc_id in accepted]
    keep = {r[0] for r in h.exact([r[:2] for r in rows]) if r[3]}
    rows = [r for r in rows if r[0] in keep]
    first = {c for _, _, c in near_brute([r[:2] for r in rows])}
    rows = mixed([r for r in rows if r[0] in first])
    want = []
    for d, t, s, lang in rows:
        ids = PLAIN.encode_ordinary(t)
        sums = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), t.encode())]
        want.append((d, lang, s, ids, len(ids), *sums))
    assert h.rows(got) == sorted(want, key=h.key)


def test_stages_keep_columns_and_odd_rows(spark, tmp_path):
    texts = [*h.ODD, *[f"good clean words here {n} " * 3 for n in range(30)], *["BAD!! BAD!! BAD!!"] * 30]
    docs = h.frame(spark, texts, extra=True)
    spark.createDataFrame([(n, int(n < 46), 0) for n in range(16, 76)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for table in (docs, docs.limit(0)):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
        assert last.count() == now.count()
    assert bpe.tokens(docs, bpe.vocabulary(), tuple(docs.columns)).count() == docs.count()
