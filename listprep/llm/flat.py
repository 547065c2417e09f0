"""Vectorised helpers on a batch of texts laid out as one run of bytes. Used inside tasks only."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; one longer text is a batch of its own.
BATCH_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def pieces(batches, column: str = "text", size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of each hold about ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.cumsum([0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()])
        start = 0
        while start < batch.num_rows:
            done = lengths[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(lengths, done + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def joined(column: pa.Array, gap: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with ``gap`` after each, and where each starts and ends; null is empty."""
    texts = [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
    data = np.frombuffer(gap.join(texts) + gap, dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes + len(gap))[:-1])) if len(texts) else np.zeros(0, np.int64)
    return data, starts.astype(np.int64), (starts + sizes).astype(np.int64)


_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64; kept while they fit, as batches are alike."""
    if len(_POWERS["up"]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPREAD = mixed(np.arange(1, 257, dtype=np.uint64))


class Hashes:
    """Hashes of slices of one run of values: equal slices have equal hashes wherever they lie."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        spread = _SPREAD[data] if data.dtype == np.uint8 else mixed(data.astype(np.uint64) + np.uint64(1))
        np.cumsum(spread * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spans = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mixed(spans ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def release() -> None:
    """At the end of a task: gives memory back, as an idle worker keeps it beside those of other stages."""
    _POWERS.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def cut_powers(limit: int = 4 * BATCH_BYTES) -> None:
    """Forgets the powers of a very long text."""
    if len(_POWERS["up"]) > limit:
        _POWERS.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
