from listprep.llm import licenses, quality
from tests.llm import helpers as h

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(docs, got, columns, brute):
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((d, *brute(t)) for d, t in texts), key=h.key)
    assert h.rows(got.select("doc_id", *columns)) == want


def test_quality_base_of_all_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check(docs, quality.quality_rules(spark, folder), BASE, h.quality_base)


def test_quality_odd_rows(spark):
    texts = [*h.ODD, "a b c a b c d", "x y\nx y\n\n \nx y", "r r r r r r", "# * $\n% & |\n<>" * 30]
    docs = h.frame(spark, texts, extra=True)
    got = quality.judge(docs)
    check(docs, got, BASE, h.quality_base)
    assert got.filter("base_failed AND kept").count() == 0
    assert quality.judge(h.frame(spark, [])).count() == 0


def test_fences_follow_their_source_and_merge(spark):
    plain = " ".join(f"w{i}" for i in range(80))
    coded = " ".join(f"w{i} #" for i in range(80))
    rows = [(i, plain, "prose") for i in range(70)] + [(100 + i, coded, "code") for i in range(70)]
    rows += [(300, coded, "prose"), (301, plain, "code"), (302, plain, "rare"), (303, None, None)]
    docs = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], h.DOCS)
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert kept[0] and kept[100] and kept[301] and kept[302]
    assert not kept[300] and not kept[303]
    fine = quality.sketches(quality.shares(quality.measured(docs)))
    once = quality.merged(fine, "lang")
    parts = fine.filter("source = '=prose'").union(fine.filter("source <> '=prose'")).repartition(7)
    assert h.rows(once) == h.rows(quality.merged(parts, "lang"))


def test_labelled_good_documents_stay(spark, folder):
    folder = folder.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality.quality_rules(spark, folder).filter("NOT base_failed").join(labels, "doc_id")
    good = got.filter("quality = 1")
    assert good.filter("kept").count() >= 0.99 * good.count()
    bad = got.filter("quality = 0")
    assert bad.filter("NOT kept").count() >= 0.6 * bad.count()


def test_plans_have_no_python(spark, folder):
    for fn in (quality.quality_rules, licenses.license_scan):
        plan = fn(spark, folder)._jdf.queryExecution().executedPlan().toString()
        found = [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in plan]
        assert not found, (fn.__name__, found)


LICENSE = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def test_license_base_of_all_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check(docs, licenses.license_scan(spark, folder), LICENSE, h.license_base)


def test_license_odd_rows(spark):
    texts = [*h.ODD, "CC BY cc-by. Cc, by", "mit license mit license", "gnu general public gnu general public license"]
    docs = h.frame(spark, texts, extra=True)
    check(docs, licenses.report(docs), LICENSE, h.license_base)
    assert licenses.report(h.frame(spark, [])).count() == 0


def test_notices_with_changed_words(spark):
    notice = next(t for t, label in licenses.NOTICES if label == "mit-text").split()
    inserted = [*notice[:9], "legal", "or", *notice[9:]]
    dropped = notice[:12] + notice[13:]
    half = notice[: len(notice) // 2]
    docs = h.frame(spark, [" ".join(["start", *w, "end"]) for w in (notice, inserted, dropped, half)])
    got = {r.doc_id: (r.labels, r.score) for r in licenses.report(docs).collect()}
    assert got[0] == ("mit-text", 1.0)
    assert got[1][0] == got[2][0] == "mit-text" and 0.8 <= got[1][1] < 1 and 0.8 <= got[2][1] < 1
    assert got[3] == ("", 0.0)
    spans = {r.doc_id: (r.start, r.end) for r in licenses.scan(docs).collect()}
    assert spans[0] == (1, 1 + len(notice)) and spans[1] == (1, 3 + len(notice))
