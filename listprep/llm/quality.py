"""Quality rules with adaptive thresholds, in DataFrame functions only.

Shares (symbols, repeated lines, repeated phrases, capitals) and word length are measured per document. Fixed-grid
histograms per language and source are the quantile sketches: a bucket is a whole number of thousandths, so two
sketches merge by adding counts, in any order, with the same result. The fences of a source with few documents lean on
the merged sketch of its language, those of a language with few documents on that of all. A document fails a rule where its value lies
above the fence of its own sketch: median plus a multiple of the distance to the lower quartile, plus a margin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listprep.llm.registry import documents, key, narrow, query, stored, whole, words

# Rule: margin in thousandths (word length: tenths of a character) above the median and its spread.
MARGINS = {"symbols": 40, "lines": 500, "phrases": 300, "capitals": 200, "length": 30}
SPREAD = 6
# Documents that a coarser group's sketch lends to each finer one.
PRIOR = 50
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def repeat_words(w: Column, size: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, the first time included. Windows are compared
    by a 64-bit hash: sorted, equal ones are neighbours; then each repeated start covers up to three words."""
    hashed = F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
    )
    return F.when(size >= 4, F.array_sort(hashed))


def _covered(ordered: Column) -> Column:
    again = F.filter(
        ordered,
        lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]) | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)),
    )
    return F.array_sort(F.transform(again, lambda x: x["i"]))


def _length(starts: Column) -> Column:
    steps = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """The counts of each document, with its language and source as keys."""
    text = F.col("_t")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    solid = F.length(F.translate(text, " \t\n\x0b\f\r", ""))
    return (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            key(F.col("lang")).alias("lang"),
            key(F.col("source")).alias("source"),
            whole(F.col("text")).alias("_t"),
        )
        .select(
            "doc_id",
            "lang",
            "source",
            words(text).alias("_w"),
            lines.alias("_l"),
            solid.cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        )
        .select("*", F.size("_w").alias("_n"))
        .select("*", repeat_words(F.col("_w"), F.col("_n")).alias("_o"))
        .select("*", _covered(F.col("_o")).alias("_s"))
        .select(
            "doc_id",
            "lang",
            "source",
            F.col("_n").cast("long").alias("n_words"),
            "word_chars",
            "n_symbols",
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            _length(F.col("_s")).alias("n_repeat_words"),
            F.size("_l").cast("long").alias("n_lines"),
            "n_capitals",
        )
    )


def shares(m: DataFrame) -> DataFrame:
    """With one column per rule: whole thousandths, word length in tenths of a character; the grid has no end."""
    part = lambda a, b, n=1000: F.expr(f"({n} * {a}) div greatest({b}, 1)")
    return m.withColumns(
        {
            "symbols": part("n_symbols", "word_chars"),
            "lines": part("n_dup_lines", "n_lines"),
            "phrases": part("n_repeat_words", "n_words"),
            "capitals": part("n_capitals", "word_chars"),
            "length": part("word_chars", "n_words", 10),
        }
    )


def sketches(m: DataFrame) -> DataFrame:
    """Histogram rows (lang, source, rule, bucket, n) of documents that have words."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("bucket")) for r in MARGINS])
    return (
        m.filter("n_words > 0")
        .select("lang", "source", F.explode(pairs).alias("p"))
        .groupBy("lang", "source", "p.rule", "p.bucket")
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches merged to coarser groups."""
    return sketch.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """Per group the number of documents and a column per rule with its fence."""
    group = Window.partitionBy(*by, "rule")
    ranked = sketch.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
    quarter = F.min(F.when(F.col("upto") * 4 >= F.col("all"), F.col("bucket")))
    middle = F.min(F.when(F.col("upto") * 2 >= F.col("all"), F.col("bucket")))
    rules = ranked.groupBy(*by, "rule").agg(quarter.alias("q1"), middle.alias("q2"), F.max("all").alias("all"))
    fence = F.col("q2") + SPREAD * (F.col("q2") - F.col("q1"))
    pick = [F.max(F.when(F.col("rule") == r, fence + margin)).alias(f"{r}_fence") for r, margin in MARGINS.items()]
    return rules.groupBy(*by).agg(F.max("all").alias("docs"), *pick)


def lent(sketch: DataFrame, documents: int, *by: str) -> DataFrame:
    """Sketches cut down to so many documents at equal ranks: at most as many rows per group and rule."""
    group = Window.partitionBy(*by, "rule")
    ranked = sketch.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
    rank = lambda upto: F.expr(f"(2 * {documents} * ({upto}) + all) div (2 * all)")
    return ranked.select(*by, "rule", "bucket", (rank("upto") - rank("upto - n")).alias("n")).filter("n > 0")


def leaning(sketch: DataFrame, wide: DataFrame, documents: int, on: str, *by: str) -> DataFrame:
    """Each group's sketch merged with what the coarser group that shares its column ``on`` lends it."""
    groups = sketch.select(on, *[c for c in by if c != on]).distinct()
    more = groups.join(lent(wide, documents, on), on).select(*by, "rule", "bucket", "n")
    return merged(sketch.select(*by, "rule", "bucket", "n").unionByName(more), *by)


def thresholds(m: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per (lang, source) with the fences that hold for it: those of its own sketch together with ``prior``
    documents of its language's; a language's sketch is its own with as many documents of all. So no verdict turns on
    one document more or less."""
    # a column that is the same in all rows stands for the group of all
    fine = sketches(m).withColumn("every", F.substring("lang", 1, 0))
    by_lang = fine.groupBy("every", "lang", "rule", "bucket").agg(F.sum("n").alias("n"))
    by_lang = leaning(by_lang, merged(fine, "every"), prior, "every", "lang")
    return fences(leaning(fine, by_lang, prior, "lang", "lang", "source"), "lang", "source").drop("docs")


def judge(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, and the rule values.

    Null and empty texts have no words and fail the base; null languages and sources are groups of their own;
    equal rows get equal verdicts; an empty table gives no rows; other columns are ignored."""
    m = stored(shares(measured(docs)), "quality-measures")
    # one row per language and source; stored, so that a hot source can be split where it is too large to look up
    limits = thresholds(m, prior).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    limits = narrow(stored(limits, "quality-fences"))
    above = F.lit(False)
    for rule in MARGINS:
        above = above | (F.col(rule) > F.col(f"{rule}_fence"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return m.join(limits, (m.lang == limits._lang) & (m.source == limits._source), "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.coalesce(~failed & ~above, F.lit(False)).alias("kept"),
        *MARGINS,
    )


@query("op10_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(documents(spark, folder))
