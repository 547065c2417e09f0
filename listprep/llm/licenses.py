"""License scans by diagonal voting, in DataFrame functions only.

Every rolling word pair of every text is joined to the positions of that pair in the license templates. A hit votes
for the diagonal (word position minus template position); votes of one text are summed per diagonal, neighbouring
diagonals are merged, as an inserted or left-out word moves the rest by one, and the words of the resulting span
are compared with the template. Only hits and spans are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listprep.llm.registry import documents, query, stored, whole

# Phrases that must stand word by word, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Notices that may vary by a few words.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd-text"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
)
# Share of the word pairs of a notice that must vote, and how far apart merged diagonals may lie.
AGREE = 0.8
BAND = 3


def text_words(text: Column) -> Column:
    """Words of the text with A-Z in lower case: digits, letters a-z and all characters beyond ASCII."""
    low = F.translate(whole(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _templates(phrases, notices) -> list[tuple[int, str, list[str], bool]]:
    return [
        (n, label, text.split(), exact)
        for n, (text, label, exact) in enumerate([(*p, True) for p in phrases] + [(*p, False) for p in notices])
    ]


def _literal(spark: SparkSession, rows, *names: str) -> DataFrame:
    """A small fixed table as literals of the plan."""
    values = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*values)))


def template_grams(spark: SparkSession, templates) -> DataFrame:
    """Positions of all word pairs of the templates: a fixed, small table."""
    rows = [(n, i, len(w), w[i], w[i + 1]) for n, _, w, _ in templates for i in range(len(w) - 1)]
    table = _literal(spark, rows, "template", "at", "length", "a", "b")
    return table.select("template", "at", "length", F.xxhash64("a", "b").alias("gram"))


def worded(docs: DataFrame) -> DataFrame:
    """doc_id, a hash that tells apart rows of one doc_id, and the words."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(whole(F.col("text"))).alias("body"),
        text_words(F.col("text")).alias("w"),
    )


def votes(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """Per text and template the diagonals with their hits; equal rows of the table vote once.

    ``excerpt`` holds the words from the pair on, as many as the template has left, to verify spans later."""
    # no filter on the number of words before: it would make the words a second time
    pairs = F.transform("w", lambda w, i: F.xxhash64(w, F.get("w", i + 1)))
    rolled = texts.select("doc_id", "body", "w", F.posexplode(pairs).alias("pos", "gram"))
    hits = rolled.join(F.broadcast(grams), "gram").select(
        "doc_id", "body", "template", "at", "length", "pos", F.slice("w", F.col("pos") + 1, 2).alias("pair")
    )
    single = hits.groupBy("doc_id", "body", "template", "length", (F.col("pos") - F.col("at")).alias("diagonal"), "at")
    return (
        single.agg(F.first("pair").alias("pair"))
        .groupBy("doc_id", "body", "template", "length", "diagonal")
        .agg(F.count("*").alias("votes"), F.sort_array(F.collect_list(F.struct("at", "pair"))).alias("hits"))
    )


def spans(diagonals: DataFrame, templates, agree: float = AGREE, band: int = BAND) -> DataFrame:
    """Verified spans (doc_id, body, label, exact, start, end, agreement).

    A phrase needs one diagonal on which all pairs voted; its words are then compared one by one. A notice may
    use neighbouring diagonals: those at most ``band`` apart form one run, the pairs of the template that any of
    them confirmed word by word count once, and their share must reach ``agree``."""
    spark = diagonals.sparkSession
    known = _literal(spark, templates, "_template", "label", "words", "exact")
    right = F.filter(
        "hits",
        lambda h: (F.get(h["pair"], F.lit(0)) == F.get("words", h["at"]))
        & (F.get(h["pair"], F.lit(1)) == F.get("words", h["at"] + 1)),
    )
    seen = (
        diagonals.join(F.broadcast(known), F.col("template") == F.col("_template"))
        .select("doc_id", "body", "template", "label", "exact", "length", "diagonal", right.alias("hits"))
        .filter(F.size("hits") > 0)
    )
    full = seen.filter(F.col("exact") & (F.size("hits") == F.col("length") - 1)).select(
        "doc_id",
        "body",
        "label",
        "exact",
        F.col("diagonal").cast("long").alias("start"),
        (F.col("diagonal") + F.col("length")).cast("long").alias("end"),
        F.lit(1.0).alias("agreement"),
    )
    group = Window.partitionBy("doc_id", "body", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(group)
    runs = (
        seen.filter(~F.col("exact") & (F.size("hits") >= 2))
        .withColumn("new", F.coalesce((gap > band).cast("int"), F.lit(0)))
        .withColumn("run", F.sum("new").over(group))
        .withColumn("h", F.explode("hits"))
        .groupBy("doc_id", "body", "template", "label", "exact", "length", "run")
        .agg(
            F.count_distinct(F.col("h.at")).alias("found"),
            F.min(F.col("diagonal") + F.col("h.at")).alias("start"),
            (F.max(F.col("diagonal") + F.col("h.at")) + 2).alias("end"),
        )
    )
    share = F.col("found") / (F.col("length") - 1)
    loose = runs.filter(share >= agree).select(
        "doc_id", "body", "label", "exact", F.col("start").cast("long"), F.col("end").cast("long"), share.alias("agreement")
    )
    return full.unionByName(loose)


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, agree: float = AGREE, band: int = BAND) -> DataFrame:
    """All verified spans of all texts (see ``spans``)."""
    templates = _templates(phrases, notices)
    return spans(votes(worded(docs), template_grams(docs.sparkSession, templates)), templates, agree, band)


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is 1 where a phrase stands word by word, else the best agreement of a notice, else 0. Null and empty
    texts have no words and no labels; rows with the same doc_id are told apart by their text, equal rows get equal
    results; an empty table gives no rows; other columns are ignored."""
    found = scan(docs, **options)
    base = F.when(F.col("exact"), F.col("start"))
    per_text = found.groupBy(F.col("doc_id").alias("_d"), F.col("body").alias("_b")).agg(
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"),
        F.max("agreement").alias("score"),
    )
    counts = worded(docs).select("doc_id", "body", F.size("w").cast("long").alias("n_words"))
    counts = stored(counts, "license-words")
    both = counts.join(per_text, counts.doc_id.eqNullSafe(per_text._d) & (counts.body == per_text._b), "left")
    return both.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )


@query("op2_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return report(documents(spark, folder))
