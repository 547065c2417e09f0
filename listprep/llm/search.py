"""Ranked lexical search, part term-at-a-time and part document-at-a-time.

One pass over the documents keeps, per document, the number of its terms and the counts of the terms that the items
ask for. Every batch of that table is a segment: its posting lists are made in the task that holds it, so no posting
is shuffled. In a segment each item takes its short lists whole and adds them up to accumulators, one per document.
The accumulators are then one more list with an upper bound, beside the long lists with theirs. Documents are visited
in order, some at a time: lists whose bounds together can't reach the worst of the best documents so far are only
looked up, never walked, and a document is given up as soon as what is left can't lift it there. The best documents of
a task carry over to its next segments; those of all tasks meet once, a few per item.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listprep.llm import flat
from listprep.llm.registry import documents, query, shipped, stored

BEST = 10
# Postings that the accumulators of one item take in a segment, at most (one list is always left whole or long).
SHORT = 2048
# Documents visited at once on the long lists.
STEP = 256
# Terms of all items of one block: a block's terms and weights are handed to every task.
BLOCK_TERMS = 50_000


def _table() -> bytes:
    """Bytes of terms stay, A-Z as a-z; all others become blanks. Characters beyond ASCII belong to terms."""
    keep = bytearray(b" " * 128) + bytearray(range(128, 256))
    for byte in (*range(0x30, 0x3A), *range(0x61, 0x7B)):
        keep[byte] = byte
    for byte in range(0x41, 0x5B):
        keep[byte] = byte + 32
    return bytes(keep)


_TABLE = _table()


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text in order, with repeats."""
    return text.translate(_TABLE).split()


def item_terms(items: DataFrame, name: str = "item_id") -> DataFrame:
    """item, body, terms: distinct terms per item. Rows with one id and different texts are items of their own,
    equal rows are one item."""
    own = items.select(F.col(name).cast("long").alias("item"), F.col("text").cast("string").alias("text")).distinct()

    def run(batches):
        for batch in flat.pieces(batches, "text"):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            found = [sorted(set(terms_of(t))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("body"), pa.array(found, pa.list_(pa.binary()))],
                names=["item", "body", "terms"],
            )

    own = own.withColumn("body", F.xxhash64("item", "text"))
    return shipped(own).mapInArrow(run, "item long, body long, terms array<binary>")


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and the document's terms of the vocabulary with their counts."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = len(vocabulary)

    def run(batches):
        for batch in flat.pieces(batches, "text"):
            sizes, terms, counts, ends = [], [], [], [0]
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms_of(text or b"")
                known = np.fromiter((vocabulary.get(w, size) for w in words), np.int64, len(words))
                found, times = np.unique(known, return_counts=True)
                if len(found) and found[-1] == size:
                    found, times = found[:-1], times[:-1]
                sizes.append(len(words))
                terms.append(found)
                counts.append(times)
                ends.append(ends[-1] + len(found))
            whole = lambda parts: pa.array(np.concatenate(parts).astype(np.int32))
            offsets = pa.array(np.array(ends, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(sizes, np.int64)),
                 pa.ListArray.from_arrays(offsets, whole(terms)), pa.ListArray.from_arrays(offsets, whole(counts))],
                names=["doc_id", "n", "terms", "counts"],
            )

    return shipped(own).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def weight(total: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * holding + 1)))


@dataclass
class Top:
    """The best documents of an item so far: scores descending, equal scores by ascending id (no id last)."""

    best: int
    scores: np.ndarray
    ids: np.ndarray
    none: np.ndarray

    @classmethod
    def empty(cls, best: int) -> Top:
        return cls(best, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    @property
    def floor(self) -> int:
        """A document below this score can't enter."""
        return int(self.scores[-1]) if len(self.scores) == self.best else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        able = scores >= self.floor
        if not able.any():
            return
        scores = np.concatenate((self.scores, scores[able]))
        ids, none = np.concatenate((self.ids, ids[able])), np.concatenate((self.none, none[able]))
        order = np.lexsort((ids, none, -scores))[: self.best]
        self.scores, self.ids, self.none = scores[order], ids[order], none[order]


class Segment:
    """Posting lists of some documents. A posting is the place of a document in id order and its share
    (10^9 tf) div (1000 tf + 8 m)."""

    def __init__(self, batch: pa.RecordBatch, total: int, length: int):
        ids = batch.column("doc_id")
        none = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, none))
        self.ids, self.none = ids[order], none[order]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        n = batch.column("n").to_numpy(zero_copy_only=False)
        m = 10 + (90 * n * total) // max(length, 1)
        terms, counts = batch.column("terms"), batch.column("counts")
        sizes = np.diff(terms.offsets.to_numpy())
        owner = np.repeat(np.arange(len(ids)), sizes)
        term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tf = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        share = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
        by = np.lexsort((place[owner], term))
        self.places, self.shares = place[owner][by], share[by]
        found, starts = np.unique(term[by], return_index=True)
        ends = np.append(starts, len(term))[1:]
        most = np.maximum.reduceat(self.shares, starts) if len(starts) else starts
        self.lists = dict(zip(found.tolist(), zip(starts.tolist(), ends.tolist(), most.tolist(), strict=True), strict=True))

    def walk(self, terms: list[int], weights: list[int], top: Top, short: int = SHORT, step: int = STEP) -> int:
        """Brings the best documents of an item up to date; how many documents were visited."""
        lists = sorted((self.lists[t][1] - self.lists[t][0], t, w) for t, w in zip(terms, weights, strict=True) if t in self.lists)
        taken, places, shares = 0, [], []
        for size, t, w in lists:
            if sum(map(len, places)) + size > short:
                break
            start, end, _ = self.lists[t]
            places.append(self.places[start:end])
            shares.append(self.shares[start:end] * w)
            taken += 1
        walked = []
        if places:
            held, back = np.unique(np.concatenate(places), return_inverse=True)
            sums = np.zeros(len(held), np.int64)
            np.add.at(sums, back, np.concatenate(shares))
            walked.append((int(sums.max()), held, sums, 1))
        for _, t, w in lists[taken:]:
            start, end, most = self.lists[t]
            walked.append((most * w, self.places[start:end], self.shares[start:end], w))
        # by bound: the first ones are left to look-ups as the floor rises
        walked.sort(key=lambda x: x[0])
        reach = np.cumsum([x[0] for x in walked])
        at, visited = 0, 0
        while at < len(self.ids):
            first = int(np.searchsorted(reach, top.floor))
            if first == len(walked):
                break
            chunks, stop = [], len(self.ids)
            for _, held, sums, w in walked[first:]:
                start = int(np.searchsorted(held, at))
                chunks.append((held[start : start + step], sums[start : start + step], w))
                if start + step < len(held):
                    stop = min(stop, int(held[start + step]))
            there = np.unique(np.concatenate([c[: np.searchsorted(c, stop)] for c, _, _ in chunks]))
            score = np.zeros(len(there), np.int64)
            for held, sums, w in chunks:
                end = int(np.searchsorted(held, stop))
                score[np.searchsorted(there, held[:end])] += sums[:end] * w
            visited += len(there)
            for i in range(first - 1, -1, -1):
                able = score + reach[i] >= top.floor
                there, score = there[able], score[able]
                if not len(there):
                    break
                _, held, sums, w = walked[i]
                spot = np.minimum(np.searchsorted(held, there), len(held) - 1)
                score = score + np.where(held[spot] == there, sums[spot] * w, 0)
            top.add(score, self.ids[there], self.none[there])
            at = stop
        return visited


def ranked(rows: DataFrame, items: list[tuple[int, list[int]]], weights: list[int], total: int, length: int, best: int) -> DataFrame:
    """The best documents of each task for each item: number of the item, doc_id, score."""

    def run(batches):
        tops = [Top.empty(best) for _ in items]
        for batch in batches:
            if batch.num_rows:
                segment = Segment(batch, total, length)
                for (_, terms), top in zip(items, tops, strict=True):
                    segment.walk(terms, [weights[t] for t in terms], top)
        number = np.repeat(np.arange(len(items)), [len(t.scores) for t in tops])
        if len(number):
            ids, none = (np.concatenate([getattr(t, k) for t in tops]) for k in ("ids", "none"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([items[i][0] for i in number.tolist()], pa.int64()), pa.array(number),
                 pa.array(ids, pa.int64(), mask=none), pa.array(np.concatenate([t.scores for t in tops]))],
                names=["item", "number", "doc_id", "score"],
            )

    return shipped(rows).mapInArrow(run, "item long, number long, doc_id long, score long")


def _block(docs: DataFrame, found: list, best: int) -> DataFrame:
    """The result rows for the items of one block."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in found for t in r.terms}))}
    rows = stored(counted(docs, vocabulary), "search-counts")
    total, length = rows.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = [weight(total, holding.get(i, 0)) for i in range(len(vocabulary))]
    items = [(r.item, [vocabulary[bytes(t)] for t in r.terms]) for r in found]
    window = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (
        ranked(rows, items, weights, total, length, best)
        .withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= best)
        .select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    )


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``best`` documents of each item: item_id, rank (from 1), doc_id, score, as whole-number scores rank them.

    Null and empty texts hold no term and are never found; an item without a term has no rows, nor has a score of 0.
    Rows with one doc_id are documents of their own, equal ones too; a null doc_id comes last among equal scores.
    Items with one id and different texts are ranked each for itself, equal rows of items once. An empty table gives no
    rows; other columns are ignored. A text of any length is one document; its terms are made in one piece.

    A block holds some ``block_terms`` terms of items, and one item at least; the terms of a block, its weights and
    no more are collected and handed to the tasks. Every block reads all documents."""
    spark = docs.sparkSession
    wanted = stored(item_terms(items), "search-items").filter(F.size("terms") > 0)
    size = wanted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_terms))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks)))
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        found = wanted.filter(F.col("block") == block).collect()
        if found:
            result = result.unionByName(_block(docs, found, best))
    return result


@query(
    "op12_ranked_search",
    sql=r"""
    WITH t AS MATERIALIZED (
        SELECT doc_id, row_number() OVER () AS row,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), s AS MATERIALIZED (
        SELECT count(*)::BIGINT AS total, sum(len(terms))::BIGINT AS length FROM t WHERE len(terms) > 0
    ), i AS MATERIALIZED (
        SELECT item_id, item, unnest(list_distinct(regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
        FROM (SELECT *, row_number() OVER () AS item FROM (SELECT DISTINCT item_id, text FROM benchmark))
    ), p AS MATERIALIZED (
        SELECT term, row, doc_id, n, count(*)::BIGINT AS tf
        FROM (SELECT doc_id, row, len(terms) AS n, unnest(terms) AS term FROM t) WHERE term IN (SELECT term FROM i)
        GROUP BY ALL
    ), w AS MATERIALIZED (
        SELECT term, floor(1000 * ln((2 * total + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM p, s GROUP BY term, total
    ), r AS (
        SELECT item_id, item, doc_id, row,
               sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // length))))::BIGINT AS score
        FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL
    )
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
          FROM r WHERE score > 0)
    WHERE rank <= 10
    """,
)
def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
