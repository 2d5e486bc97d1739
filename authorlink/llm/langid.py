"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, runs of what is not a letter become one space, and the
character 1- to 3-grams of the whole text are hashed into ``DIMENSIONS`` counts.
A feature is ``(1 + ln count) * idf``, scaled to length 1. The document frequencies
cover every document that may be learnt from; tasks add them up before Spark does.

The weights are trained by follow-the-regularised-leader (FTRL-proximal) with an
L1 and an L2 penalty, on about ``SAMPLE`` labelled documents, drawn by a hash of
their text, an equal share for each language (copies are used once). Of these every fifth
is held back, to fit one temperature that calibrates the probabilities. Reading,
counting and predicting run in Spark's tasks; the driver gets the sample's sparse
counts and the document frequencies, both of bounded size.

Defined cases. A null text, or one without a letter, is ``und`` with score 0. Without
a labelled document to learn from every text is ``und`` with score 0. Null labels are
not learnt from, empty ones are a label like another. Of equal probabilities the
label first by code point is predicted. Repeated rows are counted, and predicted,
each. An empty table gives an empty result. Very long texts are counted in parts.
Columns with the names added here are replaced, all others pass through ``predict``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common

DIMENSIONS, ORDERS = 1 << 14, (1, 2, 3)
#: Documents to learn from (the draw's expected number), and how often each is used.
SAMPLE, EPOCHS = 2400, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.0005
UNDETERMINED = "und"
#: Characters counted at a time.
PART = 1 << 18


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point to the small letter, or to a space for what is not a letter."""
    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 32
    signs = points.tobytes().decode("utf-32-le")
    return np.array([(ord(low) if len(low := s.lower()) == 1 else ord(s)) if s.isalpha() else 32 for s in signs], np.uint32)


def _hashed(points: np.ndarray) -> np.ndarray:
    """The n-grams of folded code points, as features."""
    found = []
    for n in ORDERS:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, np.uint32)
        for i in range(n):
            h = (h ^ points[i : len(points) - n + 1 + i]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        found.append(h & np.uint32(DIMENSIONS - 1))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def counts(text: str | None) -> np.ndarray | None:
    """Counts of all features of a text; None without a letter."""
    if not text:
        return None
    total, carried = None, np.array([32], np.uint32)
    fold = _folded()
    for at in range(0, len(text), PART):
        points = fold[np.frombuffer(text[at : at + PART].encode("utf-32-le", "replace"), np.uint32)]
        points = np.concatenate([carried, points, [32] if at + PART >= len(text) else []]).astype(np.uint32)
        points = points[(points != 32) | np.concatenate([[True], points[:-1] != 32])]
        n_carried = min(len(carried), max(ORDERS) - 1) if at else 0
        some = np.bincount(_hashed(points), minlength=DIMENSIONS)
        if n_carried:
            some -= np.bincount(_hashed(points[:n_carried]), minlength=DIMENSIONS)
        total = some if total is None else total + some
        carried = points[-(max(ORDERS) - 1) :]
        letters = (points != 32).any()
        total_letters = letters if at == 0 else total_letters or letters
    return total if total_letters else None


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # features by labels
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(counted)
        values = (1 + np.log(counted[places])) * self.idf[places]
        return places, values / max(np.sqrt((values * values).sum()), 1e-12)

    def logits(self, counted: np.ndarray) -> np.ndarray:
        places, values = self.features(counted)
        return (values @ self.weights[places] + self.bias) / self.temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        counted = counts(text) if self.labels else None
        if counted is None:
            return UNDETERMINED, 0.0
        p = _softmax(self.logits(counted))
        best = int(np.argmax(p))
        return self.labels[best], float(p[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over ``(places, values, label)``; the weights and the bias."""
    z, n = np.zeros((DIMENSIONS + 1, n_labels)), np.zeros((DIMENSIONS + 1, n_labels))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs = z[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(samples)):
            places, values, label = samples[i]
            at, x = np.append(places, DIMENSIONS), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    w = weights(slice(None))
    return w[:-1], w[-1]


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss; one error beyond those seen is reckoned with, so that few samples don't look certain."""
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    aim = np.full((n, k), 1 / (n + 2) / (k - 1))
    aim[np.arange(n), labels] = 1 - 1 / (n + 2)

    def loss(t: float) -> float:
        scaled = logits / t - (logits / t).max(1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(1)) - (aim * scaled).sum(1)).mean())

    return float(min(np.geomspace(0.05, 20, 121), key=loss))


def _frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents with letters, and how many hold each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                counted = counts(text.as_py())
                if counted is not None:
                    held += counted > 0
                    n += 1
        places = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(places, -1), pa.int32()), pa.array(np.append(held[places], n), pa.int64())], ["place", "n"]
        )

    found = docs.select("text").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    table, total = np.zeros(DIMENSIONS), 0
    for place, n in found.collect():  # at most one row for each feature
        if place < 0:
            total = n
        else:
            table[place] = n
    return total, table


def _sample(docs: DataFrame, limit: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Label and sparse counts of about ``limit`` labelled documents, the same ones on each run."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("text"))
    per_label = common.written(labelled.groupBy("lang").agg(F.count("h").alias("n")), "labels")
    n_labels = per_label.count()
    if not n_labels:
        return []
    each = limit / n_labels
    drawn = F.pmod("h", F.lit(1 << 30)) < F.lit(each * (1 << 30)) / F.col("n")
    chosen = labelled.join(per_label, "lang").where(drawn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if (counted := counts(text)) is not None:
                    places = np.flatnonzero(counted)
                    out.append((lang, places.astype(np.int32), counted[places].astype(np.int32)))
            lang, place, n = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(place, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))],
                ["lang", "place", "n"],
            )

    once = chosen.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text", "h")
    rows = once.mapInArrow(run, "lang string, place array<int>, n array<int>").toPandas()
    found = [(r.lang, np.asarray(r.place, np.int64), np.asarray(r.n, np.int64)) for r in rows.itertuples()]
    return sorted(found, key=lambda x: (x[0], len(x[1]), x[1].tobytes(), x[2].tobytes()))


def fit(docs: DataFrame, limit: int = SAMPLE) -> Model:
    """A model learnt from the ``text`` and ``lang`` of all given documents."""
    total, held = _frequencies(docs)
    idf = np.log((1 + total) / (1 + held)) + 1
    sample = _sample(docs, limit)
    labels = tuple(sorted({lang for lang, _, _ in sample}))
    if not labels:
        return Model((), idf, np.zeros((DIMENSIONS, 0)), np.zeros(0))
    model = Model(labels, idf, np.zeros((DIMENSIONS, len(labels))), np.zeros(len(labels)))

    def dense(places: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.bincount(places, n, DIMENSIONS)

    prepared = [(*model.features(dense(p, n)), labels.index(lang)) for lang, p, n in sample]
    held_back = [i for i in range(len(sample)) if i % 5 == 4]
    learnt = [x for i, x in enumerate(prepared) if i % 5 != 4]
    weights, bias = train(learnt, len(labels))
    logits = np.array([prepared[i][1] @ weights[prepared[i][0]] + bias for i in held_back]).reshape(-1, len(labels))
    temperature = calibrated(logits, np.array([prepared[i][2] for i in held_back], int))
    return Model(labels, idf, weights.astype(np.float32), bias, temperature)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``."""
    docs = docs.drop("lang_pred", "score")
    told = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS rows, a column for each label

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for text in texts:
            yield pd.DataFrame([told.value.predict(x) for x in text], columns=["lang_pred", "score"])

    predicted = docs.withColumn("_predicted", run("text"))
    return predicted.select(*docs.columns, "_predicted.lang_pred", "_predicted.score")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; of an empty text for a null id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id")) == 0
    model = fit(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
