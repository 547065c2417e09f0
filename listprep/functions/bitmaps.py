"""Places in bitmaps (Bloom filters), for Spark's bitmap aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of one bitmap (fixed by the aggregation), bits set per key, and keys per bitmap for one in a hundred.
BLOCK_BITS = 32768
PROBES = 5
BLOCK_KEYS = BLOCK_BITS // 10


def probe(i: int, hash_: Column) -> Column:
    """Place of a key's bit number ``i`` in its bitmap."""
    return F.pmod(F.xxhash64(F.lit(i), hash_), F.lit(BLOCK_BITS))


def probes(hash_: Column) -> Column:
    """Places of all its bits."""
    return F.array(*[probe(i, hash_) for i in range(PROBES)])


def bit_at(bits: Column, place: Column) -> Column:
    """Whether the bit at a place of a bitmap is set: byte ``place / 8``, lowest bit first."""
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


# A key may have all its bits in one word of a bitmap, so that one look at the bitmap tells.
WORD_BITS = 64


def _word(hash_: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), hash_), F.lit(BLOCK_BITS // WORD_BITS))


def _word_probe(i: int, hash_: Column) -> Column:
    """Bit number ``i`` of a key in its word, counted from the lowest one."""
    return F.pmod(F.xxhash64(F.lit(i), hash_), F.lit(WORD_BITS)).cast("int")


def word_probes(hash_: Column) -> Column:
    """Places of all bits of a key in its bitmap; the first byte of a word is the highest."""
    return F.array(*[_word(hash_) * WORD_BITS + _word_probe(i, hash_).bitwiseXOR(F.lit(WORD_BITS - 8)) for i in range(PROBES)])


def word_holds(bits: Column, hash_: Column) -> Column:
    """Whether all bits of a key are set.  ``bits`` is written once, as a scalar in it goes to the tasks once for each time."""
    own = F.substring(bits, (_word(hash_) * (WORD_BITS // 8) + 1).cast("int"), F.lit(WORD_BITS // 8))
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), _word_probe(i, hash_)))
    return F.conv(F.hex(own), 16, -10).cast("long").bitwiseAND(mask) == mask
