"""Byte-level BPE encoding and decoding.

Pre-tokenisation is vectorised and uses no regular expression. Each code point has a class; each class is a transition
function on the few states that matter ("in a word", "after a blank", "inside a contraction" ...). The functions are
composed by an associative scan over all code points of a batch, which gives the state before each code point and so
the token boundaries. The slices between boundaries are told apart by hash; each distinct slice is merged once by the
ranks, with a bounded cache, and its ids are dealt to all places. Offsets stay, so ids decode to the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm import flat
from listprep.llm.registry import documents, query, shipped, unused

# Symbols: what a code point is. A quote that begins 's 't 'm 'd has QUOTE2, one that begins 're 've 'll QUOTE3.
LETTER, NUMBER, BLANK, SPACE, OTHER, QUOTE2, QUOTE3, END = range(8)
# States after a code point: fresh start, after one blank, in a run of letters, numbers or others, in a contraction
# with two or one letters to come, after a contraction.
FRESH, PENDING, WORD, DIGITS, MARKS, TWO, ONE, CLOSED = range(8)
# White space beyond ASCII, fixed by the pattern's \s.
SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

CACHE_ENTRIES = 1 << 18
# Bytes of text encoded at once: some 50 bytes of arrays are alive for each. And the rows and bytes of the batches that
# Spark sends, which are held beside them, in the executor too.
BATCH_BYTES = 1 << 19
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def step(symbol: int, state: int) -> int:
    """State after a code point."""
    if symbol == LETTER:
        return {TWO: ONE, ONE: CLOSED}.get(state, WORD)
    if symbol in (QUOTE2, QUOTE3):
        if state in (PENDING, MARKS):
            return MARKS
        return ONE if symbol == QUOTE2 else TWO
    return {NUMBER: DIGITS, BLANK: PENDING, SPACE: FRESH, OTHER: MARKS, END: FRESH}[symbol]


def opens(symbol: int, state: int) -> bool:
    """Whether a code point that is no white space begins a token, given the state before it."""
    if state == PENDING:
        return False
    if symbol == LETTER:
        return state not in (WORD, TWO, ONE)
    if symbol == NUMBER:
        return state != DIGITS
    return state != MARKS


@cache
def machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All functions that compositions of the symbols' functions give: (function of each symbol, composition table,
    value of each function on the start state, boundary table by symbol and state)."""
    basic = [tuple(step(x, s) for s in range(8)) for x in range(8)]
    known = {f: i for i, f in enumerate(dict.fromkeys(basic))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in basic:
            both = tuple(g[s] for s in f)
            if both not in known:
                known[both] = len(known)
                todo.append(both)
    functions = list(known)
    table = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8)
    return (
        np.array([known[f] for f in basic], np.uint8),
        table.ravel(),
        np.array([f[FRESH] for f in functions], np.uint8),
        np.array([[opens(x, s) for s in range(8)] for x in range(8)]),
    )


@cache
def classes() -> np.ndarray:
    """Class of every code point, from the general categories."""
    kind = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[[9, 10, 11, 12, 13, *SPACES]] = SPACE
    table[32] = BLANK
    return table


def scan(functions: np.ndarray, block: int = 64) -> np.ndarray:
    """Running compositions of a sequence of functions: inside blocks side by side, then over the blocks' totals
    in the same way, as composition is associative."""
    _, table, _, _ = machine()
    size = len(table) and int(len(table) ** 0.5)
    if len(functions) <= block:
        out = functions.copy()
        for i in range(1, len(out)):
            out[i] = table[int(out[i - 1]) * size + int(out[i])]
        return out
    rows = -(-len(functions) // block)
    grid = np.full(rows * block, functions[-1], np.uint8)
    grid[: len(functions)] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    for i in range(1, block):
        grid[i] = table[grid[i - 1].astype(np.intp) * size + grid[i]]
    before = scan(grid[-1], block)[:-1]
    before = before.astype(np.intp) * size
    for i in range(block):  # by rows: the places take eight bytes each
        grid[i, 1:] = table[before + grid[i, 1:]]
    return grid.T.ravel()[: len(functions)]


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the code points that begin a token; ``ends`` are the places of the separators between texts."""
    symbols = classes()[points]
    symbols[ends] = END
    tick = np.flatnonzero(points == 39)
    if len(tick):
        tail = np.concatenate((points, np.zeros(2, points.dtype)))
        tail[ends] = 0
        one, two = tail[tick + 1], tail[tick + 2]
        symbols[tick[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE2
        pair = np.zeros(len(tick), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        symbols[tick[pair]] = QUOTE3
    basic, _, first, table = machine()
    after = first[scan(basic[symbols])]
    state = np.concatenate((np.array([FRESH], np.uint8), after[:-1]))
    begin = table[symbols, state]
    space = (symbols == SPACE) | (symbols == BLANK)
    solid = ~space & (symbols != END)
    nearer = np.concatenate((solid[1:], [False]))
    earlier = np.concatenate(([False], space[:-1]))
    begin = np.where(space, ~earlier | nearer, begin)
    begin[ends] = True
    return begin


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: the pair with the lowest rank is merged first, the left one of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over a linked list, for slices without a break."""
    n = len(piece)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    live = [True] * n

    def offer(heap, i):
        j = end[i]
        if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
            heappush(heap, (rank, i, j, end[j]))

    heap: list[tuple[int, int, int, int]] = []
    for i in range(n):
        offer(heap, i)
    heapify(heap)
    while heap:
        _, i, j, k = heappop(heap)
        if not live[i] or end[i] != j or not live[j] or end[j] != k:
            continue
        live[j], end[i] = False, k
        if k < n:
            before[k] = i
        offer(heap, i)
        if before[i] >= 0:
            offer(heap, before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes batches of texts; keeps ids of slices seen before, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], entries: int = CACHE_ENTRIES):
        self.ranks, self.entries, self.cache = ranks, entries, {}
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.sizes = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))

    def piece(self, data: bytes) -> list[int]:
        ids = self.cache.get(data)
        if ids is None:
            ids = merge(data, self.ranks)
            if len(data) <= 256:
                if len(self.cache) >= self.entries:
                    self.cache.clear()
                self.cache[data] = ids
        return ids

    def slices(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(bytes of all texts with a line feed after each, byte offsets of the slices, slices up to each text's end).
        The separators are slices of their own and are left out of the counts by ``encode``."""
        run = "\n".join(texts) + "\n"
        points = np.frombuffer(run.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        begin = np.flatnonzero(boundaries(points, ends))
        width = np.ones(len(points), np.uint8)
        for least in (0x80, 0x800, 0x10000):
            width += points >= least
        offsets = np.zeros(len(points) + 1, np.int64)
        np.cumsum(width, out=offsets[1:])
        return run.encode(), np.append(offsets[begin], offsets[-1]), np.searchsorted(begin, ends)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text and, for each id, the offset in bytes at which its text ends."""
        if not texts:
            return []
        data, cuts, closing = self.slices(texts)
        starts, ends = cuts[:-1], cuts[1:]
        keys = flat.Hashes(np.frombuffer(data, np.uint8)).of(starts, ends)
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        distinct = [self.piece(data[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        counts = np.fromiter(map(len, distinct), np.int64, len(distinct))
        ids_of = np.fromiter((x for ids in distinct for x in ids), np.uint32, int(counts.sum()))
        places = np.concatenate(([0], np.cumsum(counts)))
        per = counts[which]
        until = np.concatenate(([0], np.cumsum(per)))
        index = np.arange(until[-1]) - np.repeat(until[:-1] - places[which], per)
        ids = ids_of[index]
        stops = np.cumsum(self.sizes[ids])
        out, begin, at = [], 0, 0
        for n, last in enumerate(until[closing].tolist()):
            length = len(texts[n].encode())
            mine = ids[begin:last]
            if self.decode(mine) != data[at : at + length]:  # two slices with one hash
                mine = np.array([x for a, b in self._cut(texts[n]) for x in self.piece(data[at + a : at + b])], np.uint32)
            out.append((mine, stops[begin:last] - at))
            begin, at = last + len(self.piece(b"\n")), at + length + 1
        return out

    def _cut(self, text: str):
        _, cuts, closing = self.slices([text])
        inner = cuts[: closing[0] + 1].tolist()
        return zip(inner[:-1], inner[1:], strict=True)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def encoded(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ids, the offset in bytes where each id ends, and the decoded bytes.

    Null texts are encoded as empty: no ids. Repeated rows give repeated results, an empty table gives none.
    ``path`` names a file of ranks; its content (about a megabyte) goes to the executors once."""
    return _mapped(docs, path, keep, "ids array<int>, ends array<long>, decoded binary", _arrays)


def digests(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``encoded``, with the number of ids and digests of ids and decoded bytes only."""
    return _mapped(docs, path, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", _sums)


def tokens(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``digests``, with the ids themselves."""
    return _mapped(docs, path, keep, "ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string", _both)


def _both(encoder: Encoder, coded):
    return [pa.array([ids.astype(np.int32) for ids, _ in coded], pa.list_(pa.int32())), *_sums(encoder, coded)]


def _arrays(encoder: Encoder, coded):
    return [
        pa.array([ids.astype(np.int32) for ids, _ in coded], pa.list_(pa.int32())),
        pa.array([ends.astype(np.int64) for _, ends in coded], pa.list_(pa.int64())),
        pa.array([encoder.decode(ids) for ids, _ in coded], pa.binary()),
    ]


def _sums(encoder: Encoder, coded):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return [
        pa.array([len(ids) for ids, _ in coded], pa.int64()),
        pa.array([sha(ids.astype("<u4").tobytes()) for ids, _ in coded], pa.string()),
        pa.array([sha(encoder.decode(ids)) for ids, _ in coded], pa.string()),
    ]


def _mapped(docs: DataFrame, path: str, keep, schema: str, columns) -> DataFrame:
    for key, value in ARROW.items():
        docs.sparkSession.conf.set(key, value)
    with open(path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    text = unused("_text", *keep)
    own = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])

    def run(batches):
        encoder = Encoder(parse_ranks(ranks.value))
        for batch in flat.pieces(batches, text, BATCH_BYTES):
            coded = encoder.encode([t or "" for t in batch.column(text).to_pylist()])
            kept = [batch.column(i) for i in range(len(keep))]
            made = columns(encoder, coded)
            names = [*batch.schema.names[: len(keep)], *[f.split()[0] for f in schema.split(", ")]]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=names)
            del coded, made
            flat.cut_powers(4 * BATCH_BYTES)

    return shipped(own).mapInArrow(run, f"{fields}, {schema}")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op9_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return digests(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), vocabulary())
