"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common variant within r bits of both. Every distinct
fingerprint therefore stands for all its variants with up to r flipped bits, and fingerprints that share a variant
are linked. The variants are shuffled in compact form: one row per distinct leading part of the variants, and the
task that owns a leading part makes the variants with it. Leading parts that hold very many fingerprints are cut into
classes of variants by a linear code, so each task makes an equal share of them. Within a variant all fingerprints are
linked to the smallest one: any two of them are within 2r bits, so no link between components is lost, and no group is
expanded to all its pairs.
"""

from __future__ import annotations

import math
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm import flat
from listprep.llm.graph import components
from listprep.llm.registry import documents, narrow, query, shipped, stored, unused, whole
from listprep.operators.joins import join_unique

BITS = 64
WIDTH = 4
RADIUS = 2
SEED = 42
# Fingerprints of one task while links are sought, about.
LOAD = 1 << 13
# Most leading bits: their counts stay a small table.
MOST_BITS = 14

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(text: bytes, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included; of the whole sequence if there are fewer words."""
    joined = b" ".join(text.split())
    if not joined:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)]
    count = max(1, len(starts) - width + 1)
    spans = zip(starts[:count], ends[min(width, len(ends)) - 1 :], strict=True)
    view, h = memoryview(joined), xxhash.xxh64_intdigest
    return np.fromiter((h(view[a:b], seed) for a, b in spans), np.uint64, count)


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """A bit is set if it is set in over half the hashes; no words give 0."""
    hashes = shingle_hashes(text.translate(_LOWER.tobytes()), width, seed)
    if not len(hashes):
        return 0
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` with ``fp``, the 64 bits as a signed number."""
    text = unused("_text", *keep)
    own = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])

    def run(batches):
        for batch in flat.pieces(batches, text):
            fps = [fingerprint((t or "").encode(), width, seed) for t in batch.column(text).to_pylist()]
            kept = [batch.column(i) for i in range(len(keep))]
            values = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*kept, values], names=[*batch.schema.names[:-1], "fp"])

    return shipped(own).mapInArrow(run, f"{fields}, fp long")


@cache
def masks(bits: int, most: int) -> tuple[np.ndarray, ...]:
    """All flips of exactly 0, 1, ... ``most`` of ``bits`` low bits."""
    return tuple(
        np.array([sum(1 << b for b in c) for c in combinations(range(bits), n)], np.uint64) for n in range(most + 1)
    )


@cache
def _code() -> np.ndarray:
    """A random odd word per bit of a class number: the class of a value is a parity per word, so the class of a
    variant is that of its fingerprint combined with that of the flips."""
    return np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64)


def classes(values: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for i in range(bits):
        out |= (np.bitwise_count(values & _code()[i]) & 1).astype(np.int64) << i
    return out


def stars(fps: np.ndarray, lead: int, bits: int, part: int = 0, part_bits: int = 0, radius: int = RADIUS):
    """Links (fingerprint, smallest fingerprint with the same variant) over the variants whose leading ``bits`` are
    ``lead`` and whose class is ``part``. ``fps`` are the fingerprints within ``radius`` flips of ``lead``, sorted."""
    rest = np.uint64(BITS - bits)
    low = np.uint64((1 << (BITS - bits)) - 1)
    away = np.bitwise_count((fps >> rest) ^ np.uint64(lead)) if bits else np.zeros(len(fps), np.uint8)
    variants, owners = [], []
    for flips in range(radius + 1):
        index = np.flatnonzero(away == flips)
        if not len(index):
            continue
        flipped = np.concatenate(masks(BITS - bits, radius - flips))
        base = (fps[index] & low) | (np.uint64(lead) << rest if bits else np.uint64(0))
        if part_bits:
            mine, wanted = classes(flipped, part_bits), classes(base, part_bits) ^ part
            for c in range(1 << part_bits):
                rows, cols = index[wanted == c], flipped[mine == c]
                variants.append((base[wanted == c][:, None] ^ cols[None, :]).ravel())
                owners.append(np.repeat(rows.astype(np.uint32), len(cols)))
        else:
            variants.append((base[:, None] ^ flipped[None, :]).ravel())
            owners.append(np.repeat(index.astype(np.uint32), len(flipped)))
    if not variants:
        return fps[:0], fps[:0]
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    fresh = np.concatenate(([True], variant[1:] != variant[:-1]))
    starts = np.flatnonzero(fresh)
    shared = np.diff(np.append(starts, len(variant))) > 1
    if not shared.any():
        return fps[:0], fps[:0]
    least = np.minimum.reduceat(owner, starts)  # fps are sorted, so the smallest owner is the smallest fingerprint
    group = np.cumsum(fresh) - 1
    use = shared[group] & (owner != least[group])
    pairs = np.unique(owner[use].astype(np.uint64) << np.uint64(32) | least[group[use]])
    a, b = fps[pairs >> np.uint64(32)], fps[pairs & np.uint64(0xFFFFFFFF)]
    close = np.bitwise_count(a ^ b) <= 2 * radius
    return a[close], b[close]


def leading_bits(count: int, load: int = LOAD) -> int:
    """Leading bits for so many distinct fingerprints: some load per part."""
    return min(MOST_BITS, max(4, math.ceil(math.log2(max(count, 1) * 8 / load))))


def links(distinct: DataFrame, radius: int = RADIUS, load: int = LOAD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that keep all components of the relation
    "at most 2 * radius bits apart"."""
    bits = leading_bits(distinct.count(), load)
    flips = np.concatenate(masks(bits, radius)).astype(np.int64).tolist()
    lead = F.shiftrightunsigned("fp", BITS - bits)
    variants = F.explode(F.array(*[F.lit(m) for m in flips]))
    # a leading part with more than the load is cut in classes; at most 2 ** MOST_BITS rows
    crowded = (
        distinct.groupBy(lead.alias("_lead")).count().filter(F.col("count") > load)
        .select("_lead", F.least(F.lit(9), F.ceil(F.log2(F.col("count") / load))).cast("int").alias("part_bits"))
    )
    rows = distinct.select("fp", lead.alias("own"), variants.alias("flip")).select("fp", F.expr("own ^ flip").alias("lead"))
    rows = rows.join(F.broadcast(crowded), F.col("lead") == F.col("_lead"), "left")
    part_bits = F.coalesce("part_bits", F.lit(0))
    parts = F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), part_bits).cast("int") - 1))
    rows = rows.select("fp", "lead", part_bits.alias("part_bits"), parts.alias("part"))

    def find(key, batches):
        lead, part, part_bits = (k.as_py() for k in key)
        fps = np.sort(np.concatenate([b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64) for b in batches.to_batches()]))
        a, b = stars(fps, lead, bits, part, part_bits, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return shipped(rows).groupBy("lead", "part", "part_bits").applyInArrow(find, "a long, b long").distinct()


def _body() -> Column:
    """Tells apart the texts of one doc_id."""
    return F.xxhash64(whole(F.col("text")))


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, load: int = LOAD, width: int = WIDTH, body: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), and
    with ``body`` a hash of the text.

    Null texts are empty; texts without words have fingerprint zero and are linked like others; rows that repeat a
    doc_id are told apart by their texts, each one in the component of its own fingerprint; a null doc_id is the smallest
    of a component only where there is no other; an empty table gives no rows; other columns are ignored. A text of any
    length is hashed shingle by shingle."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _body().alias("body"), "text")
    prints = stored(fingerprints(own, ("doc_id", "body"), width=width), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    found = stored(links(distinct.select("fp"), radius, load), "simhash-links")
    roots = components(found)
    owner = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # a component or a fingerprint may hold a large share of the rows, so neither join stays with one task for it
    firsts = owner.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(join_unique(owner, firsts, ["root"], "inner").select("fp", "component_id"), "simhash-named")
    return join_unique(prints, named, ["fp"], "inner").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *(["body"] if body else [])
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's, with all their columns. The others are looked up by doc_id
    and text: a doc_id may stand for several texts, of which one may stay and another go. Null and empty texts, ties and
    repeated rows as in ``near_duplicates``."""
    id_, body = unused("_gone", *docs.columns), unused("_body", *docs.columns)
    gone = near_duplicates(docs, body=True).filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = narrow(stored(gone.select(F.col("doc_id").alias(id_), F.col("body").alias(body)).distinct(), "simhash-gone"))
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (_body() == F.col(body)), "left_anti")


@query("op4_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))
