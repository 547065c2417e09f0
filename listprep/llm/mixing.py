"""Mixing sources to target weights.

Each source gets a share of the words of the mix. Its documents have hash-random keys and lie in key order; the range
of keys is cut in fixed intervals (two digits of the key, two more inside), so prefix sums of words come from sums per
interval, sums of intervals, and a running sum inside one interval. No task sees a whole source, and no sampling
decides where a cut lies: reruns agree. Whole epochs are taken first, the rest up to the exact word of the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listprep.llm.registry import BLANKS, documents, key, query, stored, unused, whole

# Weights of the sources in order, repeating; the mix in percent of all words; most copies of a source.
WEIGHTS = (5, 2, 1)
PERCENT = 150
EPOCHS = 2


def n_words(text: Column) -> Column:
    """Runs of characters that are no white space."""
    cut = F.regexp_replace(whole(text), f"^{BLANKS}|{BLANKS}$", "")
    return F.when(cut == "", 0).otherwise(F.size(F.split(cut, BLANKS))).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, its join key, the random key, and the number of words."""
    doc_id = F.col("doc_id").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        key(F.col("source")).alias("src"),
        F.md5(F.coalesce(doc_id, F.lit("")).cast("binary")).alias("rank"),
        n_words(F.col("text")).alias("size"),
    ).withColumns({"d1": F.substring("rank", 1, 2), "d2": F.substring("rank", 3, 2)})


def targets(sizes: DataFrame, weights=WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """Words to take from each source: proportional to its weight, at most ``epochs`` times its size, the excess
    shared anew by weight until no target is above that.

    Sources by how soon they reach their limit: while the next one would be above it, it gets its limit, and the
    others share what is left. One row per source (src, source, source_size, target)."""
    every = Window.partitionBy()
    order = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(order - 1, len(weights)).cast("int") + 1)
    named = sizes.groupBy("src", "source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    filled = Window.orderBy(F.col("most") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    left = Window.orderBy(F.col("most") / F.col("weight"), "src").rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("most").over(filled), F.lit(0))) / F.sum("weight").over(left)
    return (
        named.withColumn("most", epochs * F.col("source_size"))
        .withColumn("budget", F.sum("source_size").over(every) * percent / 100.0)
        .withColumn("level", level)
        .withColumn("open", F.col("level") <= F.col("most") / F.col("weight"))
        .withColumn("water", F.max(F.when(F.col("open"), F.col("level"))).over(every))
        .select(
            "src",
            "source",
            "source_size",
            F.coalesce(F.least(F.col("weight") * F.col("water"), F.col("most").cast("double")), F.col("most").cast("double"))
            .alias("target"),
        )
    )


def mix(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts words with repeats: whole epochs, then the documents in key order up to the last word of the
    budget; the one at the cut gives its first words. Null texts and texts of white space have size 0 and give
    nothing; a null source is one source, the last; rows with the same doc_id have the same key and lie side by
    side, each taken for itself; an empty table gives no rows; other columns are ignored."""
    rows = stored(sized(docs), "mixing-sizes")
    goal = targets(rows, weights, percent, epochs).select(
        "src",
        "source_size",
        "target",
        F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long").alias("passes"),
    ).withColumn("rest", F.floor("target").cast("long") - F.col("passes") * F.col("source_size"))
    before = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fine = rows.groupBy("src", "d1", "d2").agg(F.sum("size").alias("words"))
    rough = rows.groupBy("src", "d1").agg(F.sum("size").alias("words"))
    rough = rough.select("src", "d1", before(Window.partitionBy("src").orderBy("d1")).alias("far"))
    fine = fine.select("src", "d1", "d2", before(Window.partitionBy("src", "d1").orderBy("d2")).alias("near"))
    starts = fine.join(rough, ["src", "d1"]).select("src", "d1", "d2", (F.col("near") + F.col("far")).alias("start"))
    starts = starts.join(goal, "src")
    inside = Window.partitionBy("src", "d1", "d2").orderBy("rank", "doc_id", "size")
    own = rows.withColumn(
        "inside", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    left = F.col("rest") - F.col("start") - F.col("inside")
    return own.join(starts, ["src", "d1", "d2"]).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("passes") + F.greatest(F.lit(0), F.least("size", left))).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, once for each time they are taken whole; the one at the cut
    is whole if at least half of it is inside the budget."""
    taken = mix(docs, **options).filter("size > 0")
    times = F.floor((F.col("taken") + F.floor(F.col("size") / 2)) / F.col("size")).cast("int")
    id_, size, words, n = (unused(c, *docs.columns) for c in ("_id", "_size", "_words", "_times"))
    taken = taken.groupBy(F.col("doc_id").alias(id_), F.col("size").alias(size)).agg(F.max(times).alias(n)).filter(F.col(n) > 0)
    own = docs.withColumn(words, n_words(F.col("text")))
    picked = own.join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(words) == F.col(size)))
    copies = F.explode(F.sequence(F.lit(1), F.col(n))).alias(n)
    return picked.select(*[F.col(f"`{c}`") for c in docs.columns], copies).drop(n)


@query(
    "op5_source_mix",
    sql=r"""
    WITH t AS (
        SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS rank,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE]
                   [((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
        FROM t GROUP BY source
    ), b AS (
        SELECT *, 2 * source_size AS most, CAST(sum(source_size) OVER () AS DOUBLE) * 150 / 100.0::DOUBLE AS budget FROM s
    ), l AS (
        SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS FIRST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                  / sum(weight) OVER (ORDER BY most / weight, source NULLS FIRST
                                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM b
    ), w AS (
        SELECT *, max(CASE WHEN level <= most / weight THEN level END) OVER () AS water FROM l
    ), g AS (
        SELECT source, source_size, coalesce(least(weight * water, most::DOUBLE), most::DOUBLE) AS target FROM w
    ), p AS (
        SELECT t.doc_id, t.source, t.size, g.source_size, g.target,
               CAST(floor(g.target / greatest(g.source_size, 1)) AS BIGINT) AS passes,
               CAST(floor(g.target) AS BIGINT) AS goal,
               CAST(coalesce(sum(size) OVER (PARTITION BY t.source ORDER BY rank, doc_id, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
        FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source
    )
    SELECT doc_id, source, size, source_size, target,
           CAST(size * passes + greatest(0, least(size, goal - passes * source_size - start)) AS BIGINT) AS taken
    FROM p
    """,
)
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(documents(spark, folder))
