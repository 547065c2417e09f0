"""Document fingerprints: SimHash of weighted terms, and permuted block tables to find what lies near.

Terms are the words of a text (A-Z in lower case) and their neighbouring pairs. A term's weight grows with the logarithm
of its count, so frequent words don't drown the others. Its 128-bit hash votes with that weight, for a set bit, or
against it; the fingerprint has the bits with more votes for than against. The share of differing bits tells the
angle between two texts' weighted terms; the cosine of that angle is their likeness.

To find fingerprints within r bits, their bits are cut in blocks. Of b > r blocks at least b - r are equal in two such
fingerprints, so for every choice of b - r blocks a table is keyed by them (the permutation brings them to the front),
and rows with equal keys are compared in full. More fingerprints take more blocks, hence longer keys, so that few others
share one; the result is the same for any number of blocks.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm import flat
from listprep.llm.registry import documents, query, shipped, stored

BITS = 128
RADIUS = 4
# Parts of a term's vote that its weight is counted in.
UNIT = 16
# Documents whose id is divisible by this are the queries of the search for near ones.
EVERY = 100

_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SECOND = np.uint64(0xA0761D6478BD642F)
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _weights(counts: np.ndarray) -> np.ndarray:
    """Whole numbers, so that sums are exact in any order."""
    return np.floor(UNIT * (1 + np.log(counts)))


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers per text. A text without words has 0."""
    out = np.zeros((len(texts), 2), np.uint64)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    # each text ends with a blank, so no word crosses
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    starts, stops = flat.runs(_WORD[data])
    if not len(starts):
        return out
    hashes = flat.Hashes(_LOWER[data]).of(starts, stops)
    owner = np.searchsorted(ends, starts, side="right")
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    pairs = flat.mixed(hashes[:-1] * _PAIR ^ hashes[1:])
    for n in range(len(texts)):
        a, b = cut[n], cut[n + 1]
        if a == b:
            continue
        terms, counts = np.unique(np.concatenate((hashes[a:b], pairs[a : b - 1])), return_counts=True)
        votes = np.zeros(BITS)
        weights = _weights(counts)
        for at in range(0, len(terms), 1 << 14):
            part = terms[at : at + (1 << 14)]
            bits = np.stack((part, flat.mixed(part ^ _SECOND)), axis=1).astype("<u8").view(np.uint8)
            votes += weights[at : at + (1 << 14)] @ np.unpackbits(bits, axis=1, bitorder="little").astype(np.float64)
        out[n] = np.packbits(votes * 2 > weights.sum(), bitorder="little").view("<u8")
    flat.cut_powers()
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the angle that the share of differing bits stands for; 0 from a right angle on."""
    away = np.bitwise_count(a ^ b).sum(axis=-1)
    return _LIKE[away]


# 1 for no differing bit, 0 for half of them or more
_LIKE = np.array([max(0.0, math.cos(math.pi * d / BITS)) if 2 * d < BITS else 0.0 for d in range(BITS + 1)])


def spelled(high: Column, low: Column) -> Column:
    """32 hex digits."""
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, high long, low long, edited_high long, edited_low long, "
          "near_edited double, near_next double")


def _compared(ids: list, texts: list[str], own: np.ndarray, following: list[str], other: np.ndarray) -> pa.RecordBatch:
    """Result rows of documents, each with the one that follows it. ``own`` and ``other`` are their fingerprints."""
    changed = [edited(t, n).encode() for t, n in zip(texts, following, strict=True)]
    prints = fingerprints(changed)
    signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
         signed(own[:, 0]), signed(own[:, 1]), signed(prints[:, 0]), signed(prints[:, 1]),
         pa.array(likeness(own, prints)), pa.array(likeness(own, other))],
        names=[f.split()[0] for f in RESULT.split(", ")],
    )


def _in_order(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(result rows of all documents but the last of each partition, first and last documents of the partitions).

    Documents are dealt by ranges of the key and sorted, so each one meets the next in its task. What meets across two
    partitions is written in the same pass, as the ranges of another pass need not be the same."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("body", F.xxhash64("text"))
    ordered = own.repartitionByRange(F.col("doc_id").asc_nulls_first(), "body").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "body", "text"
    )
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def edge(batch: pa.RecordBatch, part: int, kind: str, doc_id, text: str) -> pa.RecordBatch:
        row = {"doc_id": [doc_id], "text": [text], "part": [part], "edge": [kind]}
        names = [f.split()[0] for f in RESULT.split(", ")]
        kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}
        arrays = [pa.array(row.get(n, [None]), kinds.get(n, pa.int64())) for n in names]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(row["text"], pa.string()), pa.array([part], pa.int32()), pa.array([kind])],
            names=[*names, "text", "part", "edge"],
        )

    def run(batches):
        last, part = None, None
        for batch in flat.pieces(batches, "text"):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            prints = fingerprints([t.encode() for t in texts])
            if last is None:
                part = batch.column("part")[0].as_py()
                yield edge(batch, part, "first", ids[0], texts[0])
            else:
                ids, texts, prints = [last[0], *ids], [last[1], *texts], np.concatenate((last[2], prints))
            if len(ids) > 1:
                rows = _compared(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())],
                    names=[*rows.schema.names, "text", "part", "edge"],
                )
            last = ids[-1], texts[-1], prints[-1:]
        if last is not None:
            yield edge(batch, part, "last", last[0], last[1])

    rows = stored(shipped(ordered).mapInArrow(run, f"{RESULT}, text string, part int, edge string"), "prints-rows")
    return rows.filter("edge IS NULL").drop("text", "part", "edge"), rows.filter("edge IS NOT NULL").select("doc_id", "text", "part", "edge")


def _across(edges: DataFrame) -> DataFrame:
    """Result rows of the last documents of the partitions, each with the first of the next one; the last partition's
    with the first of all. At most as many rows as there are partitions."""
    firsts = edges.filter("edge = 'first'").select(F.col("part").alias("to"), F.col("text").alias("following"))
    lasts = edges.filter("edge = 'last'").select("doc_id", "text", "part")
    # one number per partition that holds rows: a list as long as the plan's number of partitions
    parts = [r[0] for r in firsts.select("to").orderBy("to").collect()]
    if not parts:
        return edges.sparkSession.createDataFrame([], RESULT)
    pairs = edges.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], parts[0]], strict=True)), "part int, to int")
    both = lasts.join(pairs, "part").join(firsts, "to").select("doc_id", "text", "following")

    def run(batches):
        for batch in flat.pieces(batches, "text"):
            texts, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
            own, other = (fingerprints([t.encode() for t in x]) for x in (texts, following))
            yield _compared(batch.column("doc_id").to_pylist(), texts, own, following, other)

    return shipped(both).mapInArrow(run, RESULT)


def block_count(n: int, radius: int = RADIUS) -> int:
    """Blocks for so many fingerprints: keys long enough that a random one is shared by less than one other, if the
    number of tables stays below a thousand."""
    blocks = radius + 1
    while BITS * (blocks - radius) // blocks < math.log2(max(n, 2)) + 1 and math.comb(blocks + 1, radius) <= 1000:
        blocks += 1
    return blocks


def masks(blocks: int, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Per table the bits of its key, as a mask of the high and one of the low half; tables in a fixed order."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    whole = [sum(bits[i] for i in c) for c in combinations(range(blocks), blocks - radius)]
    return [(signed(m >> 64), signed(m & (1 << 64) - 1)) for m in whole]


def near(prints: DataFrame, wanted: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """Pairs of a wanted fingerprint (high, low) and one of ``prints`` (high, low; both distinct) within ``radius``
    bits, itself included: high, low, near_high, near_low. Each pair comes from the first table whose key both share, so
    none comes twice."""
    tables = masks(blocks or block_count(prints.count(), radius), radius)
    keys = [F.xxhash64(F.lit(t), F.col("high").bitwiseAND(F.lit(a)), F.col("low").bitwiseAND(F.lit(b))) for t, (a, b) in enumerate(tables)]
    key = F.explode(F.array(*[F.struct(F.lit(t).alias("table"), k.alias("key")) for t, k in enumerate(keys)]))
    dealt = lambda df: df.select("high", "low", key.alias("k")).select("high", "low", "k.table", "k.key")
    left = dealt(wanted)
    right = dealt(prints).select(F.col("high").alias("near_high"), F.col("low").alias("near_low"), F.col("table").alias("_t"), F.col("key").alias("_k"))
    away = F.bit_count(F.expr("high ^ near_high")) + F.bit_count(F.expr("low ^ near_low"))
    # the first table in which the two agree
    first = F.lit(None).cast("int")
    for t, (a, b) in reversed(list(enumerate(tables))):
        same = F.expr("high ^ near_high").bitwiseAND(F.lit(a)) == 0
        same = same & (F.expr("low ^ near_low").bitwiseAND(F.lit(b)) == 0)
        first = F.when(same, t).otherwise(first)
    match = (F.col("key") == F.col("_k")) & (F.col("table") == F.col("_t")) & (away <= radius) & (F.col("table") == first)
    return left.join(right, match).select("high", "low", "near_high", "near_low")


def printed(docs: DataFrame, radius: int = RADIUS, every: int = EVERY) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (32 hex digits), near_edited,
    near_next, n_near.

    The next document is that of the next doc_id; nulls come first, rows of one doc_id by a hash of their text, rows
    equal in both follow each other in one task, which reads them one batch at a time; the last one's next is the first. A single document is its own next. Null texts are
    empty; a text without words has fingerprint zero. ``n_near`` is given for documents whose doc_id is divisible
    by ``every`` (else null): how many other documents have a fingerprint within ``radius`` bits. An empty table
    gives no rows; other columns are ignored. One text and the next one are held whole, of any length."""
    inner, edges = _in_order(docs)
    rows = stored(inner.unionByName(_across(edges)), "prints")
    counts = stored(rows.groupBy("high", "low").agg(F.count("*").alias("n")), "prints-distinct")
    asked = F.col("doc_id") % every == 0
    wanted = rows.filter(asked).select("high", "low").distinct()
    found = near(counts.select("high", "low"), wanted, radius)
    sizes = counts.select(F.col("high").alias("near_high"), F.col("low").alias("near_low"), "n")
    found = found.join(sizes, ["near_high", "near_low"]).groupBy(F.col("high").alias("_h"), F.col("low").alias("_l")).agg(F.sum("n").alias("n"))
    found = stored(found, "prints-near")
    both = rows.join(found, asked & (F.col("high") == F.col("_h")) & (F.col("low") == F.col("_l")), "left")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", spelled(F.col("high"), F.col("low")).alias("fingerprint"),
        spelled(F.col("edited_high"), F.col("edited_low")).alias("edited_fingerprint"), "near_edited", "near_next",
        (F.col("n") - 1).alias("n_near"),
    )


@query("op11_document_fingerprints")
def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return printed(documents(spark, folder))
