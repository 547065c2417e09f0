"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listprep.llm.registry import stored
from listprep.operators.joins import join_unique


def _checked(links: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    kept = stored(links, name)
    mark = kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return kept, tuple(mark)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root being the smallest node it is connected with.

    Large stars and small stars in turn: every node hands its larger neighbours, then its smaller ones, to its
    smallest neighbour, until the links are stars around the roots. A round is two aggregations and two joins over
    the links alone; the number of rounds grows with the logarithm of the longest chain. Minima are taken before
    the shuffle, and the joins with them keep the shape that adaptive execution can split, so a node with very many links
    is spread over tasks. Each round is written to the shared folder."""
    now, mark = _checked(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # every larger neighbour of a node is linked to the node's minimum
        large = join_unique(both.filter("b > a"), low, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "links-large")
        # every node and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_unique(large, least, ["a"], "inner")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        before = mark
        now, mark = _checked(small.filter("a <> b").distinct(), "links")
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
