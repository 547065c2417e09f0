"""Fingerprints against a plain vote, the order of documents, and the search for near ones against all pairs."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from listprep.llm import fingerprints as fp
from tests.llm import helpers as h

M = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M
    return x ^ (x >> 31)


def plain(text):
    """The fingerprint by adding up votes bit by bit; word hashes are those of the module."""
    words = [w.encode() for w in h.ws_words(text)]
    low = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not low:
        return 0
    data = b" ".join(low) + b" "
    array = np.frombuffer(data, np.uint8)
    hashes, at = [], 0
    for w in low:
        hashes.append(int(fp.flat.Hashes(array).of(np.array([at]), np.array([at + len(w)]))[0]))
        at += len(w) + 1
    pairs = [mixed((a * 0xD6E8FEB86659FD93 & M) ^ b) for a, b in zip(hashes, hashes[1:], strict=False)]
    votes = [0] * 128
    for term, n in Counter(hashes + pairs).items():
        weight = math.floor(16 * (1 + math.log(n)))
        bits = term | mixed(term ^ 0xA0761D6478BD642F) << 64
        for i in range(128):
            votes[i] += weight if bits >> i & 1 else -weight
    return sum(1 << i for i in range(128) if votes[i] > 0)


def as_int(pair):
    return int(pair[0]) | int(pair[1]) << 64


TEXTS = ["", " ", "one", "One two", "a a a b a a c", "ünï 漢字 漢字 x\ny", "the cat sat on the mat " * 40, "\x1c \x00y"]


def test_votes():
    assert [as_int(p) for p in fp.fingerprints([t.encode() for t in TEXTS])] == [plain(t) for t in TEXTS]
    assert len(set(map(plain, TEXTS))) == len(TEXTS) - 1
    assert len(fp.fingerprints([])) == 0


def test_equal_texts_wherever_they_lie():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["ab", "cd", "EF", "g"], k=rng.randrange(40000))).encode() for _ in range(4)] + [b"", b"ab"]
    alone = np.concatenate([fp.fingerprints([t]) for t in texts])
    assert (fp.fingerprints([b"x y", *texts])[1:] == alone).all()


def brute(docs, every=100, radius=fp.RADIUS):
    key = lambda r: (r[0] is not None, r[0] or 0, (lambda x: x - (1 << 64) if x >> 63 else x)(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))  # noqa: E731, E501
    rows = [(d, t or "") for d, t in sorted(docs, key=key)]
    prints = {t: plain(t) for _, t in rows}
    away = lambda a, b: (a ^ b).bit_count()
    like = lambda d: max(0.0, math.cos(math.pi * d / 128)) if d < 64 else 0.0
    hexed = lambda x: f"{x & M:016x}{x >> 64:016x}"
    out = []
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        text = t[: len(t) - half] + following[:half]
        own, new = prints[t], plain(text)
        near = sum(away(own, prints[x]) <= radius for _, x in rows) - 1 if d is not None and d % every == 0 else None
        out.append((d, len(t), hashlib.sha256(text.encode()).hexdigest(), hexed(own), hexed(new), like(away(own, new)), like(away(own, prints[following])), near))
    return sorted(out, key=h.key)


@pytest.mark.parametrize("parts", [1, 8])
def test_odd_rows(spark, parts):
    texts = [*h.ODD[:5], "long words " * 900, *h.ODD[6:], *(("z " * n) for n in range(30))]
    docs = h.frame(spark, texts, extra=True).selectExpr("*", "'x' AS part", "'x' AS edge", "1 AS high", "2 AS body", "3 AS n").repartition(parts)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
    try:
        got = h.rows(fp.printed(docs, every=3))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], 3)


def test_one_document_and_none(spark):
    assert h.rows(fp.printed(h.frame(spark, [(7, "a b c d", "s")]))) == brute([(7, "a b c d")])
    assert fp.printed(h.frame(spark, [])).count() == 0


@pytest.mark.parametrize("radius,blocks", [(0, 1), (1, 2), (2, 5), (4, 5), (4, 6), (3, None)])
def test_near_finds_all_pairs_once(spark, radius, blocks):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(128) for _ in range(6)] + [0, (1 << 128) - 1]
    prints = set(seeds)
    for s in seeds:
        for _ in range(25):
            prints.add(s ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(7))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(p & M), signed(p >> 64)) for p in prints]
    df = spark.createDataFrame(rows, "high long, low long")
    wanted = spark.createDataFrame(rows[::3], "high long, low long")
    got = [tuple(r) for r in fp.near(df, wanted, radius, blocks).collect()]
    back = lambda a, b: (a & M) | (b & M) << 64
    want = {(*a, *b) for a in rows[::3] for b in rows if (back(*a) ^ back(*b)).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_keys_grow_with_the_number_of_fingerprints():
    for n in (10, 10**6, 10**9, 10**11):
        blocks = fp.block_count(n)
        assert 128 * (blocks - fp.RADIUS) // blocks >= math.log2(n) + 1 and len(fp.masks(blocks)) <= 1000
