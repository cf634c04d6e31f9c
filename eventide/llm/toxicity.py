"""Toxicity by a weighted finite-state grammar over clauses.

A text is read as words of seven classes (insult, threat, target, negation,
report, clause end, other).  Three small transducers follow the context: how
lately something was negated, whether the clause reports another's speech, and
how lately someone was addressed.  Their composition is one table-driven
transducer that writes, at every insult or threat, the path that matched it:
plain, negated, reported or aimed at someone, in any combination.  A text's
score is a logistic function of its weighted matches by path, so a negated or
reported match counts as little as the labels say it should.

The function words of the context are fixed; insults and threats in any language
are learnt as words and word beginnings that labelled toxic texts have and clean
ones do not, each with its log odds as arc weight.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import arrow_map, keep

SAMPLE = 12_000       # labelled documents the grammar is fitted on, about
PREFIXES = (4, 5, 6)  # lengths of word beginnings that may be terms
LEAST = 4             # toxic texts that must have a term
PURE = 0.02           # clean texts per toxic text that a term may have, by rate
REACH = 3             # words over which negation and address last
REMEMBERED = 300_000  # classed words per worker

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
#: Function words of the context in four languages, and plain threats.
WORDS = {
    TARGET: "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta vous votre vos "
            "tú ti usted ustedes tus su",
    NEGATION: "not no never neither nor without isn't aren't wasn't don't doesn't didn't nicht kein keine keinen nie "
              "niemals ohne ne pas jamais aucun sans nunca jamás ningún sin",
    REPORT: "said says say wrote writes quoted quote reported called sagte sagt schrieb zitierte dit disait écrit "
            "dijo dice escribió",
    THREAT: "kill hurt destroy murder punch stab burn töten umbringen schlagen tuer frapper détruire matar golpear "
            "destruir",
}
FIXED = {w: k for k, ws in WORDS.items() for w in ws.split()}
STRIP = ".,!?;:()[]{}<>\"'«»„“”¡¿*_-|%&$#@~+=/\\^`"


class Transducer:
    """``step[state, class]`` and ``out[state, class]`` over all classes, from state 0."""

    def __init__(self, step: np.ndarray, out: np.ndarray):
        self.step, self.out = step, out

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same words; the outputs are joined as mixed digits."""
        a, b = len(self.step), len(other.step)
        radix = int(other.out.max()) + 1
        step = self.step[:, None, :] * b + other.step[None, :, :]
        out = self.out[:, None, :] * radix + other.out[None, :, :]
        return Transducer(step.reshape(a * b, -1), out.reshape(a * b, -1))


def lasting(trigger: int) -> Transducer:
    """Writes 1 while ``trigger`` lies at most ``REACH`` words back in the clause."""
    step = np.zeros((REACH + 1, 7), np.int64)
    out = np.zeros((REACH + 1, 7), np.int64)
    for s, c in product(range(REACH + 1), range(7)):
        step[s, c] = REACH if c == trigger else 0 if c == END else s if c == TARGET else max(s - 1, 0)
        out[s, c] = s > 0
    return Transducer(step, out)


def until_end(trigger: int) -> Transducer:
    """Writes 1 from ``trigger`` to the end of the clause."""
    step = np.zeros((2, 7), np.int64)
    out = np.zeros((2, 7), np.int64)
    for s, c in product(range(2), range(7)):
        step[s, c] = 1 if c == trigger else 0 if c == END else s
        out[s, c] = s
    return Transducer(step, out)


def matched() -> Transducer:
    """Writes 1 at an insult, 2 at a threat."""
    out = np.zeros((1, 7), np.int64)
    out[0, INSULT], out[0, THREAT] = 1, 2
    return Transducer(np.zeros((1, 7), np.int64), out)


GRAMMAR = matched().compose(lasting(NEGATION)).compose(until_end(REPORT)).compose(lasting(TARGET))
PATHS = 3 * 2 * 2 * 2
#: IDLE[n][s]: the state after n words of class OTHER.
IDLE = [np.arange(len(GRAMMAR.step))]
for _ in range(REACH + 1):
    IDLE.append(GRAMMAR.step[IDLE[-1], OTHER])


def terms(text: str) -> set[str]:
    """The distinct words of a text and their beginnings (marked with ``*``)."""
    words = {w.strip(STRIP) for w in set(text.lower().split())}
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    out.discard("")
    return out


class Lexicon:
    """Classes and weights of words, remembered."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[str, tuple[int, float, bool] | None] = {}

    def look(self, chunk: str) -> tuple[int, float, bool] | None:
        """(class, weight, whether the clause ends here), None for other words inside a clause."""
        if chunk in self.known:
            return self.known[chunk]
        word = chunk.strip(STRIP)
        weight = max([self.weights.get(word, 0.0), *(self.weights.get(word[:n] + "*", 0.0)
                                                     for n in PREFIXES if len(word) > n)])
        kind = INSULT if weight else FIXED.get(word, OTHER)
        ends = chunk[-1] in ".!?;"
        got = (kind, weight or 1.0, ends) if kind or ends else None
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(chunk) <= 64:
            self.known[chunk] = got
        return got

    def paths(self, text: str) -> np.ndarray:
        """Summed weights of the matches of each path."""
        out = np.zeros(PATHS)
        state, at = 0, -1
        chunks = text.lower().split()
        for i, got in enumerate(map(self.look, chunks)):
            if got is None:
                continue
            kind, weight, ends = got
            state = IDLE[min(i - at - 1, REACH + 1)][state]
            out[GRAMMAR.out[state, kind]] += weight if kind in (INSULT, THREAT) else 0.0
            state = GRAMMAR.step[state, kind]
            if ends:
                state = GRAMMAR.step[state, END]
            at = i
        return out


def signals(paths: np.ndarray) -> np.ndarray:
    """Logistic inputs: presence and damped sum of each path (words without a match are no path), and one."""
    own = paths[..., PATHS // 3:]
    return np.concatenate([own > 0, np.log1p(own), np.ones(own.shape[:-1] + (1,))], axis=-1)


class Model:
    """The learnt terms and path weights: bounded by the sample, whatever the corpus."""

    def __init__(self, weights: dict[str, float], beta: np.ndarray | None):
        self.lexicon, self.beta = Lexicon(weights), beta

    def score(self, text: str) -> float:
        if self.beta is None:
            return 0.0
        return float(1 / (1 + math.exp(-max(min(float(signals(self.lexicon.paths(text)) @ self.beta), 30), -30))))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that training never sees."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit terms and path weights on labelled rows that are not held out (``sample`` of them, by a hash of the id)."""
    marks = labels.select(F.col("doc_id").cast("long").alias("i"), F.col("toxic").cast("int").alias("toxic")).where(
        "i is not null and toxic is not null").groupBy("i").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(~held_out("i"))
    share = min(1.0, sample / max(marks.count(), 1))
    marks = marks.where(F.pmod(F.xxhash64(F.lit(7), F.col("i")), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.where(F.pmod(F.xxhash64(F.lit(7), F.col("doc_id").cast("long")), F.lit(1 << 20)) < share * (1 << 20))
    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    chosen = keep(texts.join(marks, F.col("doc_id") == F.col("i")).where("text is not null").select("text", "toxic"), "toxic")

    def count(batches):
        toxic, clean = Counter(), Counter()
        n = [0, 0]
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if y else clean).update(terms(t))
                n[1 if y else 0] += 1
        seen = [k for k in toxic]       # a term without a toxic text is of no use
        yield pa.RecordBatch.from_arrays(
            [pa.array([""] + seen), pa.array([n[1]] + [toxic[k] for k in seen], pa.int64()),
             pa.array([n[0]] + [clean[k] for k in seen], pa.int64())], names=["term", "toxic", "clean"])

    schema = "term string, toxic long, clean long"
    counts = chosen.repartition(8).mapInArrow(count, schema)
    own = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    own = own.where((F.col("toxic") >= LEAST) | (F.col("term") == ""))
    rows = {r["term"]: (r["toxic"], r["clean"]) for r in own.collect()}     # bounded by the sample
    n1, n0 = rows.pop("", (0, 0))
    if not n1 or not n0:
        return Model({}, None)
    guess = {k: a for k, (a, c) in rows.items() if c / n0 <= PURE * a / n1}

    def clean_too(batches):     # a term's clean texts, wherever they lay
        seen: Counter = Counter()
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not y:
                    seen.update(guess.keys() & terms(t))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                         names=["term", "clean"])

    clean = {r["term"]: r["n"] for r in chosen.mapInArrow(clean_too, "term string, clean long").groupBy("term").agg(
        F.sum("clean").alias("n")).collect()}
    weights = {k: math.log(((a + 0.5) / (n1 + 1)) / ((clean.get(k, 0) + 0.5) / (n0 + 1)))
               for k, a in guess.items() if clean.get(k, 0) / n0 <= PURE * a / n1}
    model = Model(weights, None)

    def read(batch):
        rows = [model.lexicon.paths(t).tolist() for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["p", "y"])

    got = chosen.mapInArrow(arrow_map(read), "p array<double>, y int").collect()    # the bounded sample's matches
    model.beta = logistic(signals(np.array([r["p"] for r in got])), np.array([float(bool(r["y"])) for r in got]))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 30) -> np.ndarray:
    """Ridge-penalised logistic weights by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ beta).clip(-30, 30)))
        grad = x.T @ (p - y) + ridge * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), grad)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``."""
    def run(batch):
        got = [model.score(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got, pa.float64()),
                                          pa.array([int(s >= 0.5) for s in got], pa.int32())],
                                         names=["doc_id", "held_out", "score", "predicted"])
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), held_out().alias("held_out"))
    return src.mapInArrow(arrow_map(run), "doc_id long, held_out boolean, score double, predicted int")


def detect(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Train on ``labels`` and score every row of ``docs``.

    Null and empty texts are scored as texts without a match; a null doc_id is
    not held out; labels with a null id or mark teach nothing, of repeated
    labels the highest counts.  Without labels of both kinds every score is 0.
    An empty table gives no rows.
    """
    return score(docs, train(docs, labels, sample))
