"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are the hashed 1- to 3-grams of a text's lower-cased characters,
weighted by TF-IDF and scaled to length one.  Document frequencies cover every
training document.  The model is trained by follow-the-regularised-leader with
elastic-net penalties (McMahan et al., 2013) on a bounded sample of the labelled
documents (``SAMPLE``, chosen by a hash of the id): shards train on their own
and their weights are averaged after each pass.  A temperature, fitted on a part
of the sample that no shard trains on, calibrates the probabilities.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import arrow_map, keep

ORDERS = (1, 2, 3)
FEATURES = 1 << 13
SAMPLE = 6_000          # labelled documents the classifier is fitted on, about
SHARDS = 6
CLASSES = 512           # most frequent labels that are learnt; rarer ones are never predicted
PASSES = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-4
UNKNOWN = "und"
BLOCK = 1 << 18         # characters hashed at once


def grams(text: bytes) -> tuple[np.ndarray, bool]:
    """(counts of the hashed n-grams of a text, whether it has letters)."""
    low = text.decode("utf-8").lower()
    counts = np.zeros(FEATURES)
    letters = False
    most = max(ORDERS)
    for lo in range(0, len(low), BLOCK):
        part = low[lo:lo + BLOCK + most - 1]
        letters = letters or any(map(str.isalpha, part))
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = np.zeros(len(c), np.uint64)
        for n in range(1, most + 1):
            if len(c) < n:
                break
            h = (h[:len(c) - n + 1] + c[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if n in ORDERS:
                own = h if lo + BLOCK >= len(low) else h[:BLOCK]
                counts += np.bincount((own >> np.uint64(8)).astype(np.int64) & (FEATURES - 1), minlength=FEATURES)
    return counts, letters


def features(text: bytes, idf: np.ndarray) -> np.ndarray | None:
    """The TF-IDF vector of length one; None where the text has no letters."""
    counts, letters = grams(text)
    if not letters:
        return None
    x = np.sqrt(counts) * idf
    return x / max(math.sqrt(float(x @ x)), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate FTRL-proximal state of a multinomial model (features by classes)."""

    def __init__(self, weights: np.ndarray, n: np.ndarray):
        self.n = n.copy()
        rate = (BETA + np.sqrt(n)) / ALPHA
        # the state that yields these weights
        self.z = -weights * (rate + L2) - np.sign(weights) * L1
        self.w = weights.copy()

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        p = softmax(x @ self.w[at])
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        z = self.z[at] + g - sigma * self.w[at]
        n = n + g * g
        self.z[at], self.n[at] = z, n
        self.w[at] = np.where(np.abs(z) <= L1, 0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


class Model:
    """Classes, document frequencies, weights and temperature; a few hundred KB whatever the corpus."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.langs, self.idf, self.weights, self.temperature = langs, idf, weights, temperature

    def predict(self, text: bytes) -> tuple[str, float]:
        x = features(text, self.idf) if self.langs else None
        if x is None:
            return UNKNOWN, 0.0
        p = softmax((x @ self.weights) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(min(max(p[k], 0.0), 1.0))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that training never sees."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows that are not held out; no labels give a model without classes.

    Of more than ``CLASSES`` labels the most frequent are learnt (equally
    frequent ones by name), as the weights are features by classes.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.col("lang").alias("lang"))
    known = src.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches):
        total, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()).to_pylist():
                total += grams(t)[0] > 0
                rows += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, FEATURES)), pa.array(np.r_[rows, total])],
                                         names=["feature", "docs"])

    df = np.zeros(FEATURES + 1)
    for r in known.select("text").mapInArrow(frequencies, "feature long, docs long").groupBy("feature").agg(
            F.sum("docs").alias("docs")).collect():       # FEATURES + 1 rows
        df[r["feature"] + 1] = r["docs"]
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1
    # where a noisy column holds more labels than that, the rows of the rarer ones teach nothing
    often = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(CLASSES)
    langs = sorted(r[0] for r in often.collect())    # CLASSES rows at most
    known = known.where(F.col("lang").isin(langs))
    if not langs:
        return Model([], idf, np.zeros((FEATURES, 0)), 1.0)
    place = {x: i for i, x in enumerate(langs)}
    share = min(1.0, sample / df[0])
    roll = F.pmod(F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    deal = F.pmod(F.xxhash64(F.lit(8), F.col("doc_id")), F.lit(SHARDS + 1)).cast("int")
    chosen = keep(known.where(roll < share).select("doc_id", "text", "lang", deal.alias("shard")), "langid")

    def fit(weights, n):
        def run(pdf):
            model = Ftrl(weights, n)
            for text, lang in pdf.sort_values("doc_id")[["text", "lang"]].itertuples(index=False):
                x = features(text.encode("utf-8"), idf)
                if x is not None:
                    at = np.flatnonzero(x)
                    model.learn(at, x[at], place[lang])
            import pandas as pd
            return pd.DataFrame({"w": [model.w.tobytes()], "n": [(model.n - n).tobytes()]})
        return run

    weights = np.zeros((FEATURES, len(langs)))
    n = np.zeros_like(weights)
    for _ in range(PASSES):     # SHARDS models of FEATURES by classes each: bounded
        got = chosen.where(F.col("shard") < SHARDS).groupBy("shard").applyInPandas(
            fit(weights, n), "w binary, n binary").collect()
        if got:
            weights = np.mean([np.frombuffer(r["w"]).reshape(weights.shape) for r in got], axis=0)
            n = n + np.mean([np.frombuffer(r["n"]).reshape(weights.shape) for r in got], axis=0)

    def logits(batch):
        rows = [(features(t, idf), place[x]) for t, x in zip(
            batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist())]
        rows = [(x @ weights, y) for x, y in rows if x is not None]
        yield pa.RecordBatch.from_arrays([pa.array([z.tolist() for z, _ in rows], pa.list_(pa.float64())),
                                          pa.array([y for _, y in rows], pa.int32())], names=["z", "y"])

    held = chosen.where(F.col("shard") == SHARDS).select("text", "lang").mapInArrow(
        arrow_map(logits), "z array<double>, y int").collect()     # a seventh of the bounded sample
    return Model(langs, idf, weights, temperature(np.array([r["z"] for r in held]).reshape(-1, len(langs)),
                                                  np.array([r["y"] for r in held], int)))


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm; 1 without rows."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(softmax(z / math.exp(t))[np.arange(len(y)), y].clip(1e-12)).mean()
    lo, hi, g = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row; ``und`` and 0 for null texts and texts without letters."""
    def run(batch):
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        got = [model.predict(t) if t else (UNKNOWN, 0.0) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([g for g, _ in got], pa.string()),
                                          pa.array([s for _, s in got], pa.float64())],
                                         names=["doc_id", "held_out", "lang_pred", "score"])
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), held_out().alias("held_out"))
    return src.mapInArrow(arrow_map(run), "doc_id long, held_out boolean, lang_pred string, score double")


def detect(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Train on ``docs`` and predict every row of it.

    Rows with a null lang train nothing; rows with a null doc_id are not held
    out; repeated rows are predicted each.  Without any labelled row every
    prediction is ``und``.  An empty table gives no rows.
    """
    return identify(docs, train(docs, sample))


def keep_identified(docs: DataFrame, least: float = 0.0, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` (all columns) with a language: ``und`` and scores under ``least`` go.

    Scores are never below 0, so with ``least`` 0 only texts without letters go.  Without any
    labelled row there is nothing to score: the texts with letters stay, whatever ``least``.
    The decision is taken per text, in place, so no row is moved.
    """
    model = train(docs, sample)

    @F.pandas_udf("boolean")
    def spoken(texts):
        import pandas as pd

        def known(text):
            if not model.langs:
                return grams(text)[1]
            lang, score = model.predict(text)
            return lang != UNKNOWN and score >= least
        return pd.Series([bool(t) and known(t.encode("utf-8")) for t in texts], dtype=bool)
    return docs.where(spoken(docs["text"]))
