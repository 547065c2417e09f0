"""Toxicity by a weighted grammar of finite-state transducers.

Words become symbols: insult, threat, target, negation, report, other, end of a clause. Small transducers read the
symbols of one clause and say, at every insult or threat, whether it is negated, aimed at somebody, reported speech, or
one of several; their composition is one machine whose output is the context of each hit. A hit weighs its lexical
weight times the weight of its context, a clause the sum of its hits, a document a logistic function of its clauses. A threat
that no target precedes stays open until one follows in its clause.

Lexical weights come from labelled rows: whole words and word beginnings that are found nearly only in toxic texts, next
to a short fixed list. Words are found in whole byte arrays; only clauses with a hit are walked through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.llm import flat
from listprep.llm.classifier import held_out, one_text, sample
from listprep.llm.registry import documents, query, shipped, unused

# Labelled rows of the fit and entries of the learned lexicon, at most.
TRAIN_ROWS = 20000
LEXICON = 20000
# A learned entry: found in so many toxic rows, at least this share of its rows toxic, and this likelihood ratio.
LEAST_ROWS, LEAST_SHARE, LEAST_RATIO = 4, 0.75, 16.0
# Bytes of word beginnings; 0 is the whole word.
STEMS = (0, 4, 5, 6, 7, 8)
TOXIC = 0.5

# Fixed word lists.
INSULTS = "idiot stupid moron loser trash scum worthless pathetic disgusting clown dumb fool jerk garbage vermin".split()
THREATS = "kill hurt destroy strangle stab shoot hang burn".split()
TARGETS = "you your you're youre u yours he she him her they them these those everyone nobody".split()
NEGATIONS = "not no never n't isn't aren't wasn't don't doesn't without nobody's".split()
REPORTS = "said says say wrote writes called calls claimed claims quoted quote reported reports told".split()
FIXED_WEIGHT = 3.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
HITS = (INSULT, THREAT)


@dataclass(frozen=True)
class Transducer:
    """``move(state, symbol)`` is the next state; ``say(state)`` is what it says at a hit it is in ``state`` for."""

    states: int
    move: Callable[[int, int], int]
    say: Callable[[int], int]


# A negation reaches over three words; a target and a report over the rest of the clause.
NEGATED = Transducer(4, lambda s, x: 0 if x == END else 3 if x == NEGATION else max(s - 1, 0), lambda s: int(s > 0))
AIMED = Transducer(2, lambda s, x: 0 if x == END else 1 if x == TARGET else s, lambda s: s)
REPORTED = Transducer(2, lambda s, x: 0 if x == END else 1 if x == REPORT else s, lambda s: s)
PILED = Transducer(2, lambda s, x: 0 if x == END else 1 if x in HITS else s, lambda s: s)
GRAMMAR = (NEGATED, AIMED, REPORTED, PILED)
# The bit of a context that says "aimed".
AIM = 1 << GRAMMAR.index(AIMED)
# Weight of a hit that is negated, aimed, reported, one of several.
FACTORS = (0.3, 1.5, 0.5, 1.2)


def compose(parts: tuple[Transducer, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The product machine: (next state by state and symbol, context by state); a context has a bit per part."""
    states = list(product(*[range(p.states) for p in parts]))
    name = {s: i for i, s in enumerate(states)}
    moves = np.array([[name[tuple(p.move(q, x) for p, q in zip(parts, s, strict=True))] for x in range(7)] for s in states])
    context = np.array([sum(p.say(q) << i for i, (p, q) in enumerate(zip(parts, s, strict=True))) for s in states])
    return moves, context


MOVES, CONTEXT = compose(GRAMMAR)
CONTEXT_WEIGHT = np.array([np.prod([f for i, f in enumerate(FACTORS) if c >> i & 1]) for c in range(1 << len(GRAMMAR))])

_LETTER = np.zeros(256, bool)
_LETTER[[39, *range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CLOSE = np.zeros(256, bool)
_CLOSE[[ord(c) for c in ".!?;:\n"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def entries(words: list[str]) -> np.ndarray:
    """Hashes of whole words, as ``Words`` makes them."""
    run = "\n".join(words).encode() + b"\n"
    data = np.frombuffer(run, np.uint8)
    ends = np.flatnonzero(data == 10)
    return flat.Hashes(data).of(np.concatenate(([0], ends[:-1] + 1)), ends)


class Words:
    """The words of a batch: text number, clause number, and hashes of the whole and of beginnings."""

    def __init__(self, texts: pa.Array):
        data, starts, _ = flat.joined(texts, b"\n")
        self.begin, self.end = flat.runs(_LETTER[data])
        self.text = np.searchsorted(starts, self.begin, side="right") - 1
        self.clause = np.cumsum(_CLOSE[data])[self.begin] if len(data) else self.begin
        self.hashes = flat.Hashes(_LOWER[data])

    def stems(self):
        """(length, places, hashes) for the whole words and for beginnings of words that are longer."""
        for n in STEMS:
            at = np.flatnonzero(self.end - self.begin > n) if n else np.arange(len(self.begin))
            values = self.hashes.of(self.begin[at], self.begin[at] + n if n else self.end[at])
            yield n, at, flat.mixed(values + np.uint64(n))


@dataclass
class Lexicon:
    """Sorted hashes of words and beginnings with their weights."""

    names: np.ndarray
    weights: np.ndarray
    table: np.ndarray = field(init=False)
    fixed: dict[int, np.ndarray] = field(init=False)

    def __post_init__(self):
        own = flat.mixed(entries(INSULTS))
        new = own[~np.isin(own, self.names)]
        names = np.concatenate((self.names, new))
        weights = np.concatenate((self.weights, np.full(len(new), FIXED_WEIGHT)))
        order = np.argsort(names)
        self.names, self.weights = names[order], weights[order]
        self.table = np.zeros(1 << 20, bool)
        self.table[self.names >> np.uint64(44)] = True
        lists = ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
        self.fixed = {symbol: np.sort(flat.mixed(entries(words))) for symbol, words in lists}

    def weigh(self, words: Words) -> np.ndarray:
        """Lexical weight of every word, 0 for most: the largest of the whole word's and its beginnings'."""
        out = np.zeros(len(words.begin))
        for _, at, values in words.stems():
            may = self.table[values >> np.uint64(44)]
            at, values = at[may], values[may]
            place = np.minimum(np.searchsorted(self.names, values), len(self.names) - 1)
            known = self.names[place] == values
            np.maximum.at(out, at[known], self.weights[place[known]])
        return out


def clauses(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, score, contexts) of every clause with a hit; contexts count the hits that are negated, aimed,
    reported and piled up."""
    words = Words(texts)
    weight = lexicon.weigh(words)
    whole = flat.mixed(words.hashes.of(words.begin, words.end))
    threat = np.isin(whole, lexicon.fixed[THREAT])
    hit = (weight > 0) | threat
    mine = np.flatnonzero(np.isin(words.clause, np.unique(words.clause[hit])))
    symbol = np.zeros(len(mine), np.int64)
    for kind, names in lexicon.fixed.items():
        symbol[np.isin(whole[mine], names)] = kind
    symbol[weight[mine] > 0] = INSULT
    value = np.where(symbol == THREAT, FIXED_WEIGHT, weight[mine])
    found_text, found_score, found_context = [], [], []
    state, last, waiting = 0, None, []
    for text, clause, x, v in zip(
        words.text[mine].tolist(), words.clause[mine].tolist(), symbol.tolist(), value.tolist(), strict=True
    ):
        if clause != last:
            state, last, waiting = int(MOVES[state, END]), clause, []
            found_text.append(text)
            found_score.append(0.0)
            found_context.append([0] * len(GRAMMAR))
        counted = []
        if x in HITS:
            context = int(CONTEXT[state])
            # a threat counts only where it is aimed at somebody, named before it or after it
            (counted if x == INSULT or context & AIM else waiting).append((v, context))
        elif x == TARGET and waiting:
            counted, waiting = [(w, context | AIM) for w, context in waiting], []
        for w, context in counted:
            found_score[-1] += w * CONTEXT_WEIGHT[context]
            for i in range(len(GRAMMAR)):
                found_context[-1][i] += context >> i & 1
        state = int(MOVES[state, x])
    return np.array(found_text, np.int64), np.array(found_score), np.array(found_context).reshape(-1, len(GRAMMAR))


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Per text: sum and maximum of the clauses' scores, their number (logarithms), and the share of hits negated,
    aimed and reported."""
    text, score, context = clauses(texts, lexicon)
    text, score, context = text[score > 0], score[score > 0], context[score > 0]
    n = len(texts)
    total, number = np.bincount(text, score, n), np.bincount(text, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, text, score)
    shares = [np.bincount(text, context[:, i] > 0, n) / np.maximum(number, 1) for i in range(3)]
    return np.column_stack((np.log1p(total), np.log1p(most), np.log1p(number), *shares))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # the last is the bias

    def probability(self, texts: pa.Array) -> np.ndarray:
        x = features(texts, self.lexicon)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, pull: float = 0.5, rounds: int = 60) -> np.ndarray:
    """Weights and bias by damped Newton steps, drawn weakly to "more is worse"."""
    prior = np.array([0.5, 0.5, 0.5, -0.5, 0.5, -0.5, -2.0])[-x.shape[1] - 1 :]
    z, w = np.column_stack((x, np.ones(len(x)))), prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + pull * (w - prior)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull * np.eye(len(w)), gradient)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def learned(rows: DataFrame) -> Lexicon:
    """The lexicon of labelled rows (label, text). Each batch counts its own words before they are shuffled; the
    entries that stay are at most ``LEXICON``."""

    def count(batches):
        for batch in flat.pieces(batches):
            label = np.asarray(batch.column("label").to_pylist(), np.int64)
            words = Words(batch.column("text"))
            names = np.concatenate([v for _, _, v in words.stems()])
            texts = np.concatenate([words.text[at] for _, at, _ in words.stems()])
            order = np.lexsort((texts, names))
            names, texts = names[order], texts[order]
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]) | (texts[1:] != texts[:-1])
            names, toxic = names[new], label[texts[new]]
            if len(names):
                first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
                bad = np.add.reduceat(toxic, first)
                every = np.diff(np.append(first, len(names)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[first].view(np.int64)), pa.array(bad), pa.array(every - bad)], names=["name", "bad", "good"]
                )
            flat.cut_powers()

    sizes = rows.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    share = (sizes.b + 1) / (sizes.n + 2)
    counts = shipped(rows).mapInArrow(count, "name long, bad long, good long").groupBy("name").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    n = F.col("bad") + F.col("good")
    part = lambda a, p: F.when(a > 0, a * F.log(a / (n * p))).otherwise(0.0)
    ratio = 2 * (part(F.col("bad"), share) + part(F.col("good"), 1 - share))
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)) - float(np.log(share / (1 - share)))
    best = (
        counts.filter((F.col("bad") >= LEAST_ROWS) & (F.col("bad") >= LEAST_SHARE * n))
        .select("name", ratio.alias("ratio"), F.least(odds, F.lit(6.0)).alias("weight"))
        .filter(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "name")
        .limit(LEXICON)
        .collect()
    )
    names = np.array([r.name for r in best], np.int64).view(np.uint64)
    return Lexicon(names, np.array([max(r.weight, 0.1) for r in best]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Lexicon and logistic weights from at most ``rows`` labelled rows outside the held-out fold. The lexicon comes
    from four fifths of them, by hash, the weights from the rest; the sample is of fixed size, so texts stay put."""
    few = sample(labels, label, rows).select(F.col("doc_id").alias("_id"), "label")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")
    own = one_text(own).select("label", "text", (F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(5)) == 0).alias("rest"))
    lexicon = learned(own.filter(~F.col("rest")))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    names = [f"f{i}" for i in range(6)]

    def measure(batches):
        for batch in flat.pieces(batches):
            x = features(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("label"), *map(pa.array, x.T)], names=["label", *names])
            flat.cut_powers()

    schema = "label int, " + ", ".join(f"{n} double" for n in names)
    got = own.filter("rest").select("label", "text").mapInArrow(measure, schema).toPandas()
    return Model(lexicon, logistic(got[names].to_numpy(float).reshape(-1, 6), got["label"].to_numpy(float)))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns ``keep`` with the probability of label 1 as ``name``."""
    text = unused("_text", name, *keep)
    own = docs.select(*[docs[f"`{c}`"] for c in keep], docs["text"].cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in flat.pieces(batches, text):
            p = shared.value.probability(batch.column(text))
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p)], names=[*batch.schema.names[:-1], name])
            flat.cut_powers()

    return shipped(own).mapInArrow(run, f"{fields}, `{name}` double")


def rate(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic: float = TOXIC) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have no clauses and get the score of the bias, as do texts without a hit; without labels the
    fixed lists and weights hold; of several labels of one doc_id the largest counts; repeated rows get equal scores; an
    empty table gives no rows; other columns are ignored."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(own, fit(docs, labels, label)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxic).cast("int").alias("predicted"),
    )


@query("op7_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return rate(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
