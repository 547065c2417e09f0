import random
import re

import numpy as np
import xxhash

from listprep.llm import graph, simhash
from tests.llm import helpers as h


def fp(text):
    w = h.ws_words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def brute(pairs, most=4):
    fps = [fp(t) for _, t in pairs]
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= most).tolist():
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        r = find(i)
        if d is not None and (r not in least or d < least[r]):
            least[r] = d
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(pairs, fps, strict=True))), key=h.key)


def near(seed, n):
    """Chains of texts, each a small change of the one before."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(500)}" for _ in range(300)]
    out = []
    for _ in range(n):
        words = list(words)
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def pairs(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_fingerprints():
    for t in [*h.ODD, *near(1, 20)]:
        text = t[1] if isinstance(t, tuple) else t
        assert simhash.fingerprint((text or "").encode()) == fp(text)


def test_odd_rows_and_chains(spark):
    docs = h.frame(spark, [*h.ODD, *near(1, 60), *near(2, 30)], extra=True)
    got = h.rows(simhash.near_duplicates(docs))
    assert got == brute(pairs(docs))
    assert simhash.near_duplicates(h.frame(spark, [])).count() == 0
    firsts = simhash.one_of_each(docs)
    assert firsts.columns == docs.columns
    assert {r.doc_id for r in firsts.collect()} == {c for _, _, c in got}


def ball(rng, n):
    """Fingerprints around a few centres, near and just out of reach."""
    centres = [rng.getrandbits(64) for _ in range(5)]
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(n):
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randrange(8)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


def test_links_keep_components_also_with_crowded_parts(spark):
    fps = ball(random.Random(3), 400)
    values = np.array(fps, np.uint64)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for load in (1 << 13, 40):
        found = simhash.links(frame, load=load).collect()
        edges = np.array([(r.a, r.b) for r in found], np.int64).view(np.uint64)
        assert (np.bitwise_count(edges[:, 0] ^ edges[:, 1]) <= 4).all()
        want = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4) if j > i]
        assert partition(len(fps), want) == partition(len(fps), np.searchsorted(values, edges).tolist())


def partition(n, edges):
    root = list(range(n))
    for a, b in edges:
        ra, rb = root[a], root[b]
        if ra != rb:
            root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return root


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(300, 700)] + [(900, 901), (902, 901), (5, 5)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 200: 200, **{i: 200 for i in range(300, 700)}, 900: 900, 901: 900, 902: 900}


def test_query(spark, folder):
    got = simhash.simhash_near_dedup(spark, folder)
    assert h.rows(got) == brute(pairs(spark.read.parquet(f"{folder}/documents.parquet")))
