"""Term search over texts, as token matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default search terms, by topic.
SEARCH_TERMS = tuple(
    """
    js lib db node react vue angular ts api web ui app tool test server client data util utils core plugin module
    express next nest webpack babel eslint redux mobx graphql prisma mongoose
    component middleware framework starter boilerplate template sdk cli package toolkit
    auth database cache queue stream crypto format parse convert transform validate
    aws azure google firebase mongo postgres redis docker kubernetes cloud
    dev build deploy monitor debug log config env security performance
    """.split()
)


def tokens(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def term_hits(df: DataFrame, text: str, terms: Sequence[str] = SEARCH_TERMS, query: str = "query") -> DataFrame:
    """One row per (row, term found).  The term list is a parameter of fixed size held as a literal,
    so matching happens inside the scan stage and nothing is joined."""
    wanted = F.lit([t.lower() for t in terms])
    return df.withColumn(query, F.explode(F.array_intersect(tokens(F.col(text)), wanted)))


def term_counts(df: DataFrame, text: str, terms: Sequence[str] = SEARCH_TERMS) -> DataFrame:
    """Rows per term; terms without a hit count 0."""
    counted = term_hits(df.select(text), text, terms).groupBy("query").agg(F.count("*").alias("n"))
    listed = df.sparkSession.createDataFrame([(t,) for t in terms], "query string")
    return listed.join(counted, "query", "left").select("query", F.coalesce("n", F.lit(0)).alias("n"))
