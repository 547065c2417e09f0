"""Quality classifier: Naive Bayes support vectors.

A text is a set of n-grams: words, word pairs, and one to three neighbouring shapes (how a word is written, whether it
repeats the word before, runs of marks). The indicators are scaled by the log ratio of their smoothed class counts, the
scaled vector has unit length, and a linear model with hinge loss is fitted by dual coordinate descent. A logistic
curve, fitted on rows left out of the descent, turns margins into probabilities.

Features come from whole byte arrays of a batch. The fit uses a bounded, hash-ordered sample of labelled rows; scores
cover every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm import flat
from listprep.llm.registry import documents, query, shipped, unused

# Labelled rows of the fit at most, and n-grams of the model at most (those in most documents).
TRAIN_ROWS = 5000
FEATURES = 1 << 16
LEAST_DOCS = 3
FOLDS = 5
ACCEPT = 0.3
# Bytes of text scored at once: a text has several n-grams for each word.
BATCH_BYTES = 1 << 20

_WORD, _DIGIT, _MARK, _GAP = range(4)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _GAP
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _WORD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return flat.mixed(a * np.uint64(3) + flat.mixed(b + np.uint64(salt)))


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, n-gram) of all n-grams of a batch, repeats included."""
    data, starts, _ = flat.joined(texts, b"\n")
    kind = _KIND[data]
    edge = np.concatenate(([True], kind[1:] != kind[:-1]))
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(data))
    solid = kind[begin] != _GAP
    begin, end = begin[solid], end[solid]
    what = kind[begin]
    text = np.searchsorted(starts, begin, side="right") - 1
    value = flat.Hashes(_LOWER[data]).of(begin, end)
    capitals = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    upper = capitals[end] - capitals[begin]
    first = capitals[begin + 1] - capitals[begin]
    shape = np.where(upper == 0, 1, np.where((upper == end - begin) & (upper > 1), 2, np.where((upper == 1) & (first == 1), 3, 4)))
    word = np.flatnonzero(what == _WORD)
    again = np.zeros(len(begin), bool)
    if len(word) > 1:
        again[word[1:]] = (value[word[1:]] == value[word[:-1]]) & (text[word[1:]] == text[word[:-1]])
    shape = shape + 4 * again
    spaced = np.concatenate(([True], begin[1:] != end[:-1]))
    symbol = np.where(what == _WORD, shape.astype(np.uint64), np.where(what == _DIGIT, np.uint64(20), value))
    symbol = flat.mixed(symbol * np.uint64(2) + spaced)
    near = text[1:] == text[:-1]
    nearer = near[1:] & near[:-1]
    wnear = text[word[1:]] == text[word[:-1]]
    two = _pair(symbol[:-1], symbol[1:], 2)
    parts = [
        (text, flat.mixed(symbol + np.uint64(1))),
        (text[1:][near], two[near]),
        (text[2:][nearer], _pair(two[:-1][nearer], symbol[2:][nearer], 3)),
        (text[word], flat.mixed(value[word] + np.uint64(4))),
        (text[word[1:]][wnear], _pair(value[word[:-1]][wnear], value[word[1:]][wnear], 5)),
    ]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def gram_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct n-grams of each text, sorted."""
    text, gram = grams(texts)
    order = np.lexsort((gram, text))
    text, gram = text[order], gram[order]
    keep = np.ones(len(gram), bool)
    keep[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
    text, gram = text[keep], gram[keep]
    return np.split(gram, np.searchsorted(text, np.arange(1, len(texts))))


@dataclass
class Model:
    """Sorted n-grams, their log-count ratios and weights, the bias, and the logistic curve."""

    grams: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def lookup(self) -> np.ndarray:
        """Table over the leading 22 bits: no n-gram of the model there if false."""
        table = np.zeros(1 << 22, bool)
        table[self.grams >> np.uint64(42)] = True
        return table

    def margins(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        text, gram = grams(texts)
        may = table[gram >> np.uint64(42)]
        text, gram = text[may], gram[may]
        at = np.searchsorted(self.grams, gram)
        at[at == len(self.grams)] = 0
        known = self.grams[at] == gram if len(self.grams) else np.zeros(len(gram), bool)
        seen = np.unique(text[known] * np.int64(len(self.grams) + 1) + at[known])
        text, at = np.divmod(seen, len(self.grams) + 1)
        total = np.bincount(text, self.weights[at] * self.ratios[at], len(texts))
        norm = np.sqrt(np.bincount(text, self.ratios[at] ** 2, len(texts)))
        return total / np.maximum(norm, 1e-9) + self.bias

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = 1.0, rounds: int = 30,
            tolerance: float = 1e-3, seed: int = 1) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for min |w|^2 / 2 + cost * sum of hinge losses; rows are (places, values) and the
    bias is a constant feature. Classes have the same total cost."""
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    square = np.array([float(v @ v) + 1 for _, v in rows])
    share = {c: max(1, int((y == c).sum())) for c in (-1.0, 1.0)}
    most = np.array([cost * len(rows) / (2 * share[c]) for c in y.tolist()])
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in random.permutation(len(rows)):
            at, v = rows[i]
            gradient = y[i] * (w[at] @ v + bias) - 1
            projected = min(gradient, 0) if alpha[i] <= 0 else max(gradient, 0) if alpha[i] >= most[i] else gradient
            worst = max(worst, abs(projected))
            if abs(projected) > 1e-12:
                before = alpha[i]
                alpha[i] = min(max(before - gradient / square[i], 0), most[i])
                move = (alpha[i] - before) * y[i]
                w[at] += move * v
                bias += move
        if worst < tolerance:
            break
    return w, bias


def curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps, with a weak pull to slope 2 and the classes' share."""
    a, b, target = 2.0, 0.0, (labels * (labels.sum() + 1) / (labels.sum() + 2)) + (1 - labels) / ((1 - labels).sum() + 2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum() + 0.1 * (a - 2), (p - target).sum() + 1e-3 * b])
        h = p * (1 - p)
        m = np.array([[(h * margins**2).sum() + 0.1, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(m, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(max(a, 0.1)), float(b)


def train(sets: list[np.ndarray], labels: np.ndarray, left_out: np.ndarray) -> Model:
    """The model of some rows given as sets of n-grams."""
    fit = np.flatnonzero(~left_out)
    every = np.concatenate([sets[i] for i in fit]) if len(fit) else np.zeros(0, np.uint64)
    names, counts = np.unique(every, return_counts=True)
    names, counts = names[counts >= LEAST_DOCS], counts[counts >= LEAST_DOCS]
    if len(names) > FEATURES:
        names = np.sort(names[np.lexsort((names, -counts))[:FEATURES]])
    if not len(names) or len(set(labels[fit].tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    at = [np.searchsorted(names, s[np.isin(s, names, assume_unique=True)]) for s in sets]
    plus, minus = np.ones(len(names)), np.ones(len(names))
    for i in fit:
        (plus if labels[i] else minus)[at[i]] += 1
    ratios = np.log((plus / plus.sum()) / (minus / minus.sum()))
    rows = []
    for a in at:
        v = ratios[a]
        rows.append((a, v / max(float(np.sqrt(v @ v)), 1e-9)))
    y = np.where(labels > 0, 1.0, -1.0)
    w, bias = descend([rows[i] for i in fit], y[fit], len(names))
    margins = np.array([w[a] @ v + bias for a, v in rows])
    judged = left_out if 0 < labels[left_out].sum() < left_out.sum() else np.ones(len(labels), bool)
    return Model(names, ratios, w, bias, *curve(margins[judged], labels[judged].astype(float)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` rows outside the held-out fold, in the order of a hash."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    own = own.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def one_text(rows: DataFrame) -> DataFrame:
    """One row for each doc_id: of several texts the one with the smallest hash, chosen before the shuffle."""
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Fits on at most ``rows`` labelled rows outside the held-out fold; every fifth of them, by hash, only shapes the
    curve. The sample is of fixed size, so joining it needs no shuffle of texts and one task can hold it."""
    few = sample(labels, label, rows).select(F.col("doc_id").alias("_id"), "label")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")
    own = one_text(own)

    def sets(batches):
        for batch in flat.pieces(batches):
            found = pa.array([s.view(np.int64) for s in gram_sets(batch.column("text"))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["doc_id", "label", "grams"])

    def learn(_, rows_: pd.DataFrame) -> pd.DataFrame:
        rows_ = rows_.sort_values("doc_id", kind="stable")
        ids = rows_["doc_id"].to_numpy().astype(np.uint64)
        m = train([g.view(np.uint64) for g in rows_["grams"]], rows_["label"].to_numpy(), flat.mixed(ids) % np.uint64(5) == 0)
        head = pd.DataFrame({"gram": [0, 1, 2], "ratio": [0.0] * 3, "weight": [m.bias, m.slope, m.offset], "head": [True] * 3})
        body = pd.DataFrame({"gram": m.grams.view(np.int64), "ratio": m.ratios, "weight": m.weights, "head": False})
        flat.release()
        return pd.concat([head, body])

    found = shipped(own).mapInArrow(sets, "doc_id long, label int, grams array<long>")
    table = found.groupBy(F.lit(0).alias("k")).applyInPandas(learn, "gram long, ratio double, weight double, head boolean")
    got = table.toPandas()
    if not len(got):
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0.0, 1.0, 0.0)
    head = got[got["head"]].sort_values("gram")["weight"].tolist()
    body = got[~got["head"].astype(bool)]
    names = body["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    return Model(names[order], body["ratio"].to_numpy()[order], body["weight"].to_numpy()[order], *head)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns ``keep`` with the probability of label 1 as ``name``. The model (at most ``FEATURES`` n-grams) goes
    to the executors once; texts are not shuffled. Null texts are scored as empty, by the bias alone."""
    text = unused("_text", name, *keep)
    own = docs.select(*[docs[f"`{c}`"] for c in keep], docs["text"].cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        table = shared.value.lookup()
        for batch in flat.pieces(batches, text, BATCH_BYTES):
            p = shared.value.probability(shared.value.margins(batch.column(text), table))
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p)], names=[*batch.schema.names[:-1], name])
            flat.cut_powers()

    return shipped(own).mapInArrow(run, f"{fields}, `{name}` double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Empty and null texts get the score of a text without n-grams; without usable labels all scores are the share of
    label 1 (0.5 if there is none); a label of an unknown or null doc_id is not used, of several labels of one doc_id
    the largest counts; repeated rows get equal scores; an empty table gives no rows; other columns are ignored."""
    model = fit(docs, labels, label)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(own, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= accept).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    name = unused("_quality_score", *docs.columns)
    scored = score(docs, fit(docs, labels, label), tuple(docs.columns), name)
    return scored.filter(F.col(name) >= accept).drop(name)


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
