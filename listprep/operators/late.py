"""Wide columns are read late: rows are decided on by their keys alone, then only those rows' wide columns are read.

A table of wanted keys becomes a set of bitmaps (a Bloom filter of bounded size) that goes to every scan as a scalar.
Rows that can't be wanted end at the scan; what passes (all wanted rows and some two in a hundred others) is worked on
where it was read, and the exact join comes after that, on what is left of a row. So a page's text is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listprep.functions.bitmaps import BLOCK_KEYS, word_holds, word_probes

# Bitmaps of 4 KB each, at most: some 6.7 million keys at full sharpness. More keys let more rows pass, none is lost.
MOST_BLOCKS = 2048


def _block(hash_: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("late"), hash_), blocks).cast("int")


def maybe_in(key: Column, wanted: DataFrame, column: str, most_blocks: int = MOST_BLOCKS) -> Column:
    """True for every row whose key is among the values of ``column`` of ``wanted``, and for few others; a null key is in
    none. The table of wanted keys is read when the rows are, not now."""
    hashes = wanted.filter(F.col(column).isNotNull()).select(F.xxhash64(column).alias("_hash")).distinct()
    sized = F.greatest(F.lit(1), F.least(F.lit(most_blocks), F.ceil(F.count("*") / BLOCK_KEYS))).cast("int")
    blocks = hashes.agg(sized.alias("_blocks")).scalar()
    bits = (
        hashes.select(_block(F.col("_hash"), blocks).alias("_block"), F.explode(word_probes(F.col("_hash"))).alias("_bit"))
        .groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        .agg(F.map_from_entries(F.collect_list(F.struct("_block", "_bits"))).alias("_map"))
        .select(F.transform(F.sequence(F.lit(0), F.lit(most_blocks - 1)), lambda b: F.try_element_at("_map", b)).alias("_dense"))
        .scalar()
    )
    hash_ = F.xxhash64(key)
    own = F.get(bits, _block(hash_, blocks))
    return F.coalesce(key.isNotNull() & word_holds(own, hash_), F.lit(False))
