"""The corpus pipeline: from documents to token ids.

Every stage takes (spark, docs, sf_dir) and gives a table; ``run`` writes each one as Parquet below
``spark.checkpoint.dir`` and reads it again for the next stage. All stages but the last keep the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listprep.llm import bpe, classifier, exact, mixing, simhash
from listprep.llm.registry import documents, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; repeated rows stay or go together."""
    return classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id; rows that repeat doc_id and text stay together."""
    return exact.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, over any number of links, the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: documents over the budget go, those taken twice are there twice, those without
    words go. The document at the cut stays whole if half of it or more is inside the budget."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and digests of ids and decoded bytes; one row per row of the mix."""
    return bpe.tokens(docs.select("doc_id", "lang", "source", "text"), bpe.vocabulary(), ("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("source mix", mix),
    ("byte-level BPE", encode),
]

# A fitted classifier is no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
