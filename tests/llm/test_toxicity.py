import zlib

import numpy as np
import pyarrow as pa

from listprep.llm import toxicity as t
from tests.llm import helpers as h
from tests.llm.test_classifier import auc

EMPTY = t.Lexicon(np.zeros(0, np.uint64), np.zeros(0))


def clause_scores(*texts):
    return t.clauses(pa.array(texts), EMPTY)[1].tolist()


def test_context_changes_the_weight_of_a_hit():
    plain, aimed, negated, reported = clause_scores("an idiot", "you idiot", "he is not an idiot", "somebody said idiot")
    assert plain == 3.0 and aimed == 3.0 * 1.5
    assert negated < plain and reported == plain * 0.5
    assert clause_scores("no one two three four idiot")[0] == plain
    assert clause_scores("not so. Idiot!")[0] == plain
    assert clause_scores("idiot moron")[0] == plain + plain * 1.2


def test_threats_need_a_target():
    assert clause_scores("burn the paper") == [0.0]
    assert clause_scores("you will burn")[0] == 3.0 * 1.5


def test_a_target_may_follow_its_threat():
    full = 3.0 * 1.5
    assert clause_scores("I will kill you", "somebody should hurt them", "you will burn") == [full] * 3
    assert np.allclose(clause_scores("I will not kill you", "you will not burn"), full * 0.3)
    assert np.allclose(clause_scores("somebody said kill them", "somebody said you burn"), full * 0.5)
    assert np.allclose(clause_scores("somebody said never hurt them"), full * 0.3 * 0.5)
    assert np.allclose(clause_scores("kill and burn you"), full + full * 1.2)
    assert clause_scores("kill you and them") == [full]
    assert clause_scores("burn the paper. You may go") == [0.0]
    assert clause_scores("burn the paper", "you may go") == [0.0]
    assert clause_scores("burn the paper. You burn") == [0.0, full]


def test_a_threat_before_its_target_counts_as_one_after_it():
    got = t.features(pa.array(["I will kill you", "you will burn", "burn the paper"]), EMPTY)
    assert np.allclose(got[0], got[1]) and got[0].any() and not got[2].any()


def test_composition_equals_running_all_parts():
    rng = np.random.default_rng(2)
    states, state = [0] * len(t.GRAMMAR), 0
    for x in rng.integers(0, 7, 3000).tolist():
        said = sum(p.say(s) << i for i, (p, s) in enumerate(zip(t.GRAMMAR, states, strict=True)))
        assert t.CONTEXT[state] == said
        states = [p.move(s, x) for p, s in zip(t.GRAMMAR, states, strict=True)]
        state = t.MOVES[state, x]


def test_batches_do_not_matter():
    texts = ["you idiot. fine", None, "", "scum", "ok", "not trash you see"]
    both = t.features(pa.array(texts), EMPTY)
    alone = np.vstack([t.features(pa.array([x], pa.string()), EMPTY) for x in texts])
    assert np.allclose(both, alone)


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = t.toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    out = [r for r in rows if r.held_out]
    labels = np.array([r.toxic for r in out])
    predicted = np.array([r.predicted for r in out])
    print(auc(np.array([r.score for r in out]), labels), predicted[labels == 1].mean(), predicted[labels == 0].mean())
    assert auc(np.array([r.score for r in out]), labels) > 0.93
    assert predicted[labels == 1].mean() > 0.85 and predicted[labels == 0].mean() < 0.02


def test_odd_rows(spark):
    docs = h.frame(spark, [*h.ODD, *["fine words"] * 20, *["you blarg"] * 20], extra=True)
    labels = spark.createDataFrame(
        [(n, 1, int(n >= 36)) for n in range(16, 56)] + [(None, 1, 1), (9999, 0, 0), (20, None, None)],
        "doc_id long, quality int, toxic int",
    )
    by = {r.doc_id: r for r in t.rate(docs, labels).collect()}
    assert len(by) and by[50].score > 0.5 and by[20].score < 0.3
    assert t.rate(docs, labels).count() == docs.count()
    assert t.rate(docs, labels.limit(0)).count() == docs.count()
    assert t.rate(h.frame(spark, []), labels).count() == 0
