"""The quality classifier against plain Python: n-grams by a walk over tokens, ratios, descent and scores with dicts."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from listprep.llm import classifier, flat

TOKEN = re.compile(rb"(?P<word>[A-Za-z\x80-\xff]+)|(?P<digit>[0-9]+)|(?P<mark>[^A-Za-z0-9\x80-\xff\t-\r ]+)")
TEXTS = ["Ab ab ab! cd", "", None, "x\n\ny 12 x", "AB*** CD***", "a,b c", "Straße straße 5é", "iPhone IPHONE I a", " \x00 x"]


def plain_grams(text):
    text, symbols, words, end = (text or "").encode(), [], [], None
    for token in TOKEN.finditer(text):
        kind, value, spaced = token.lastgroup, token.group().lower(), token.start() != end
        end = token.end()
        if kind == "word":
            upper = sum(65 <= c <= 90 for c in token.group())
            if not upper:
                shape = "small"
            elif upper == len(value) > 1:
                shape = "capitals"
            else:
                shape = "title" if upper == 1 and 65 <= token.group()[0] <= 90 else "mixed"
            symbols.append((kind, shape, bool(words) and words[-1] == value, spaced))
            words.append(value)
        else:
            symbols.append((kind, value if kind == "mark" else "", spaced))
    found = {("shape", *symbols[i : i + n]) for n in (1, 2, 3) for i in range(len(symbols) - n + 1)}
    return found | {("word", *words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)}


def test_grams_of_a_walk_over_tokens():
    plain = [plain_grams(text) for text in TEXTS]
    packed = [set(s.tolist()) for s in classifier.gram_sets(pa.array(TEXTS))]
    # hashes stand for n-grams one to one: all texts share as many as they should
    assert [[len(a & b) for b in packed] for a in packed] == [[len(a & b) for b in plain] for a in plain]


def plain_scores(texts, labels):
    """Scores of {doc_id: text} learned from {doc_id: 0 or 1}."""
    ids = sorted(i for i in labels if zlib.crc32(str(i).encode()) % 5)
    sets = {i: plain_grams(text) for i, text in texts.items()}
    left_out = {i for i in ids if int(flat.mixed(np.array([i], np.uint64))[0]) % 5 == 0}
    fit = [i for i in ids if i not in left_out]
    seen = {0: {}, 1: {}}
    for i in fit:
        for gram in sets[i]:
            seen[labels[i]][gram] = seen[labels[i]].get(gram, 0) + 1
    known = [g for g in seen[0] | seen[1] if seen[0].get(g, 0) + seen[1].get(g, 0) >= classifier.LEAST_DOCS]
    total = {c: sum(seen[c].get(g, 0) + 1 for g in known) for c in seen}
    ratio = {g: math.log((seen[1].get(g, 0) + 1) / total[1]) - math.log((seen[0].get(g, 0) + 1) / total[0]) for g in known}

    def vector(i):
        own = {g: ratio[g] for g in sets[i] if g in ratio}
        norm = max(math.sqrt(sum(v * v for v in own.values())), 1e-9)
        return {g: v / norm for g, v in own.items()}

    vectors, weights, bias = {i: vector(i) for i in texts}, dict.fromkeys(known, 0.0), 0.0

    def margin(i):
        return sum(weights[g] * v for g, v in vectors[i].items()) + bias

    alpha, order = dict.fromkeys(fit, 0.0), np.random.default_rng(1)
    for _ in range(30):
        worst = 0.0
        for n in order.permutation(len(fit)):
            i = fit[n]
            sign, most = 2 * labels[i] - 1, len(fit) / (2 * sum(labels[j] == labels[i] for j in fit))
            slope = sign * margin(i) - 1
            new = min(max(alpha[i] - slope / (sum(v * v for v in vectors[i].values()) + 1), 0), most)
            inside = 0 < alpha[i] < most or (alpha[i] <= 0 and slope < 0) or (alpha[i] >= most and slope > 0)
            worst = max(worst, abs(slope) if inside else 0)
            for gram, v in vectors[i].items():
                weights[gram] += (new - alpha[i]) * sign * v
            bias += (new - alpha[i]) * sign
            alpha[i] = new
        if worst < 1e-3:
            break
    judged = sorted(left_out)
    a, b = classifier.curve(np.array([margin(i) for i in judged]), np.array([labels[i] for i in judged], float))
    return {i: 1 / (1 + math.exp(-(a * margin(i) + b))) for i in texts}


def test_scores_of_plain_python(spark):
    draw = random.Random(3)
    good, bad = "the river runs past a Small town and fields of corn".split(), "BUY now!!! cheap $$$ 100 click click here corn a".split()
    texts, labels = {}, {}
    for i in range(240):
        labels[i] = int(draw.random() < 0.6)
        words = [draw.choice(good if draw.random() < (0.8 if labels[i] else 0.3) else bad) for _ in range(draw.randrange(3, 25))]
        texts[i] = " ".join(words)
    texts |= {1000 + n: text for n, text in enumerate(TEXTS)}
    want = plain_scores(texts, labels)
    assert len({round(s, 6) for s in want.values()}) > 100
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = classifier.classify(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")).collect()
    assert len(rows) == len(texts)
    worst = max(abs(r.score - want[r.doc_id]) for r in rows)
    assert worst < 1e-6
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
