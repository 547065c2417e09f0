"""Secret scans with one combined automaton.

All rules are compiled together: subset construction over bytes, minimisation, transition arrays. One pass over the
bytes of a batch tells where any rule accepts. Only stretches with such a place are looked at again: the rule's own
anchored automaton finds the exact spans, from the left, longest first, without overlap.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm import automaton, flat
from listprep.llm.registry import documents, query, shipped, unused


@dataclass(frozen=True)
class Rule:
    """``prefix`` then one or more of ``body``. The match counts if ``least`` characters of the body
    are there; shorter ones are passed over as a whole."""

    kind: str
    prefix: str
    body: str
    least: int


# The base kinds in their order, then kinds of our own.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 6),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 30),
    Rule("slack", "xox[abprs]-[0-9]+-", "[A-Za-z0-9]", 10),
    Rule("live", "[sr]k_live_", "[A-Za-z0-9]", 16),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 16),
    Rule("key", "-----BEGIN (RSA |EC |OPENSSH |DSA )?PRIVATE KEY", "-", 5),
)
BASE = ("assign", "access", "hex")
# Characters of a body after which the combined automaton reports a place: one where the prefix tells enough.
# The rule's own automaton decides. Higher counts multiply the states, as matches of other rules run along.
PROBE, PROBE_ALONE = 1, 12


@cache
def combined(rules: tuple[Rule, ...]) -> automaton.Automaton:
    """All rules in one automaton, with as much of each body as tells a place worth a look."""
    return automaton.compile_rules([f"{r.prefix}{r.body}{{{PROBE if r.prefix else PROBE_ALONE}}}" for r in rules])


@cache
def single(rule: Rule) -> tuple[automaton.Automaton, automaton.Automaton, np.ndarray, np.ndarray]:
    """(prefix and body of any length, prefix alone, bytes that can begin a match, bytes that can be in one)."""
    full = automaton.compile_rules([f"{rule.prefix}{rule.body}+"], anchored=True)
    prefix = automaton.compile_rules([rule.prefix], anchored=True) if rule.prefix else None
    table = full.moves.reshape(-1, full.width)
    begins = table[0][full.byte_class] != full.dead
    inside = (table != full.dead).any(axis=0)[full.byte_class]
    return full, prefix, begins, inside


def rule_spans(rule: Rule, data: bytes, places: list[int]) -> list[tuple[int, int]]:
    """Spans of a rule in stretches around the bytes at which it accepts, from the left, without overlap."""
    full, prefix, begins, inside = single(rule)
    found, done = [], 0
    # a place and state from which no match ends is met once, so the time is linear in the stretch
    for place in places:
        if place < done:
            continue
        low = place
        while low > done and inside[data[low - 1]]:
            low -= 1
        high = place + 1
        while high < len(data) and inside[data[high]]:
            high += 1
        at, barren = low, automaton.Barren(low, high)
        while at < high:
            end = automaton.longest(full, data, at, high, barren) if begins[data[at]] else -1
            if end < 0:
                at += 1
                continue
            body = automaton.longest(prefix, data, at, end) if prefix else at
            if end - body >= rule.least:
                found.append((at, end))
            at = end
        done = high
    return found


def scan_batch(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """Per text the spans (rule, start, end) in code points, end exclusive, by start and then rule."""
    whole = combined(rules)
    run = b"\n".join(texts) + b"\n"
    data = np.frombuffer(run, np.uint8)
    hits = automaton.scan(whole, data)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begin = np.concatenate(([0], np.cumsum(sizes)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = np.searchsorted(begin, hits, side="right") - 1
    for n in np.unique(owner).tolist():
        text = texts[n]
        local = (hits[owner == n] - begin[n]).tolist()
        spans = [(r, a, b) for r, rule in enumerate(rules) for a, b in rule_spans(rule, text, local)]
        tail = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
        out[n] = sorted(((r, int(tail[a]), int(tail[b])) for r, a, b in spans), key=lambda s: (s[1], s[0]))
    return out


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns ``keep`` with ``found``: an array of (kind, start, end) in code points.

    Null and empty texts have none; repeated rows give repeated results; an empty table gives no rows."""
    text = unused("_text", *keep)
    own = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in flat.pieces(batches, text):
            texts = [(t or "").encode() for t in batch.column(text).to_pylist()]
            found = [
                [{"kind": rules[r].kind, "start": a, "end": b} for r, a, b in spans] for spans in scan_batch(texts, rules)
            ]
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind)], names=[*batch.schema.names[:-1], "found"])

    return shipped(own).mapInArrow(run, f"{fields}, found array<struct<kind:string,start:bigint,end:bigint>>")


def spelled(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


@query("op8_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs).select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("found")).alias("spans"),
    )
