"""A user's columns may have any name, also one the operators use inside; documents may share an id."""

import time

import corpus_pipeline
from listprep.llm import exact, mixing, quality, secrets, simhash
from listprep.llm.graph import components
from tests.llm import helpers as h
from tests.test_scale import executed_plan, small_thresholds  # noqa: F401

INSIDE = ["_text", "_quality_score", "_digest", "_gone_id", "_sha", "_gone", "_body", "_words", "_times", "_times_", "_id", "_size",
          "_copy", "fp", "body", "ids", "node", "root", "score", "rank", "label", "_metadata_"]


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    texts = [*h.ODD, *[f"good clean words here {n} " * 3 for n in range(30)], *["BAD!! BAD!! BAD!!"] * 30]
    docs = h.frame(spark, texts)
    for n, name in enumerate(INSIDE):
        docs = docs.selectExpr("*", f"'{n}' AS `{name}`")
    spark.createDataFrame([(n, int(n < 46), 0) for n in range(16, 76)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all(r[name] == str(n) for r in rows for n, name in enumerate(INSIDE))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_exact_on_unions_and_joins_of_files(spark, tmp_path):
    docs = h.frame(spark, h.ODD)
    docs.write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    want = h.exact([(r.doc_id, r.text) for r in docs.collect()])
    assert h.rows(exact.deduplicate(stored.limit(0).union(stored))) == want
    assert h.rows(exact.deduplicate(stored.join(spark.range(1)))) == want


def test_rows_of_one_id_with_different_texts(spark):
    one = " ".join(f"word{n} more" for n in range(60))
    other = " ".join(f"alpha{n} beta" for n in range(60))
    docs = h.frame(spark, [(1, one, "s"), (3, one, "s"), (3, other, "s"), (3, other, "s"), (None, one, "s")])
    left = sorted((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect())
    assert left == [(1, one), (3, other), (3, other)]
    assert mixing.mixed_documents(docs).count() > 0


def test_secret_scan_takes_time_in_proportion():
    texts = [b"eyJ" * n + b"abcdef012345" for n in (20_000, 400_000)]
    for text in texts:
        start = time.time()
        secrets.scan_batch([text])
        assert time.time() - start < 20
    text = ("token=" + "a" * 5 + " password=") * 5000 + "xox" + "b-1" * 3000
    start = time.time()
    secrets.scan_batch([text.encode()])
    assert time.time() - start < 20


def test_a_node_with_very_many_links_is_split(spark, small_thresholds):  # noqa: F811
    star = spark.range(1, 60_000).selectExpr("id AS a", "0L AS b")
    other = spark.range(100_000, 130_000).selectExpr("id AS a", "100000 + (id - 100000) div 50 * 50 AS b")
    got = components(star.union(other).repartition(8))
    sizes = {r.root: r.n for r in got.groupBy("root").count().withColumnRenamed("count", "n").collect()}
    assert sizes[0] == 60_000 and len(sizes) == 601
    from listprep.operators.joins import join_unique

    both = star.union(other).repartition(8)
    low = both.groupBy("b").agg({"a": "min"}).withColumnRenamed("min(a)", "m")
    assert "skew=true" in executed_plan(join_unique(both, low, ["b"], "inner"))


def prose(n, word="word"):
    return " ".join(f"{word}{n}x{i}" for i in range(60))


def test_quality_verdicts_do_not_jump_with_the_size_of_a_source(spark):
    """The fence of a source moves little from 49 to 50 and 51 documents."""
    found = []
    for size in (49, 50, 51):
        docs = [(n, prose(n), "big") for n in range(300)] + [(1000 + n, prose(n, "long" * 9), "small") for n in range(size)]
        limits = quality.thresholds(quality.shares(quality.measured(h.frame(spark, docs))))
        found.append({(r.lang, r.source): r.length_fence for r in limits.collect()})
    for key in found[0]:
        assert abs(found[0][key] - found[1][key]) < 5 and abs(found[1][key] - found[2][key]) < 5


def test_quality_fails_very_long_words(spark):
    """In a language of long words, words ten times as long are still told apart."""
    docs = [(n, prose(n, "w" * (30 + n % 15)), "s") for n in range(200)] + [(999, prose(1, "w" * 400), "s")]
    got = {r.doc_id: r for r in quality.judge(h.frame(spark, docs)).collect()}
    assert not got[999].base_failed and not got[999].kept
    assert all(got[n].kept for n in range(200))


def plain_verdicts(rows, prior):
    """kept by sorted lists instead of histograms; rows (lang, source, values, base_failed, has words)."""
    def lent(values):
        """So many values at equal ranks: value i of n comes as often as half-up rounded shares say."""
        n = len(values)
        at = lambda i: (2 * prior * i + n) // (2 * n)
        return [v for i, v in enumerate(sorted(values)) for _ in range(at(i + 1) - at(i))]

    def fence(values, rule):
        values, n = sorted(values), len(values)
        quarter, middle = values[-(-n // 4) - 1], values[-(-n // 2) - 1]
        return middle + quality.SPREAD * (middle - quarter) + quality.MARGINS[rule]

    solid = [r for r in rows if r[4]]
    out, known = [], {}
    for lang, source, values, failed, words in rows:
        for rule in quality.MARGINS:
            if words and (lang, source, rule) not in known:
                of = lambda test: [r[2][rule] for r in solid if test(r)]  # noqa: B023, E731
                wide = of(lambda r: r[0] == lang) + lent(of(lambda r: True))  # noqa: B023
                own = of(lambda r: r[:2] == (lang, source)) + lent(wide)  # noqa: B023
                known[lang, source, rule] = fence(own, rule)
        above = words and any(values[rule] > known[lang, source, rule] for rule in quality.MARGINS)
        out.append(words and not failed and not above)
    return out


def test_quality_verdicts_against_sorted_lists(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = quality.judge(docs).join(docs.select("doc_id", "lang", "source"), "doc_id").collect()
    rows = [(r.lang, r.source, {k: r[k] for k in quality.MARGINS}, r.base_failed, r.n_words > 0) for r in got]
    assert [r.kept for r in got] == plain_verdicts(rows, quality.PRIOR)
