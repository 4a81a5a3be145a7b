"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import WordHashes, bounded_batches, held_out, mix64
from presswork.llm.training import fit_in_task, training_rows

#: Bound of the training sample: about so many rows of each label.
ROWS_PER_LABEL = 6_000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 0.1
#: Features of fewer training rows are left out.
MIN_ROWS = 3
FEATURE_BITS = 40
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_KINDS = [np.uint64(k) for k in (0x1B873593, 0x2545F491, 0x369DEA0F)]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None, hashes: dict) -> np.ndarray:
    """Distinct hashes of the words, word pairs and pairs with one word skipped of a whole text."""
    words = _WORD.findall(text.lower()) if text else []
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    found = [mix64(codes + _KINDS[0])]
    for gap in (1, 2):
        found.append(mix64(mix64(codes[:-gap] + _KINDS[gap]) * _STEP + codes[gap:]))
    return np.unique(np.concatenate(found) >> np.uint64(64 - FEATURE_BITS))


class Ftrl:
    """Per-coordinate learning rates with an L1 bound that leaves most weights at zero."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def bias(self) -> float:
        return -self.bias_z / ((BETA + self.bias_n**0.5) / ALPHA)

    def update(self, at: np.ndarray, label: int) -> None:
        w, bias = self.weights(at), self.bias()
        gradient = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
        square = gradient * gradient
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + square) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + square
        rate = ((self.bias_n + square) ** 0.5 - self.bias_n**0.5) / ALPHA
        self.bias_z += gradient - rate * bias
        self.bias_n += square


def fit(batches: Iterator[pd.DataFrame]) -> bytes:
    """Model of a bounded sample with columns ``text, label``: (keys, weights, bias), pickled.

    Without rows of both labels the model is the bias that scores every text low (or high, if
    all rows are toxic).
    """
    hashes, rows, labels = WordHashes(), [], []
    for batch in batches:
        rows += [features(text, hashes) for text in batch["text"]]
        labels += [int(label) for label in batch["label"]]
    if len(set(labels)) < 2:
        bias = 4.0 if 1 in labels else -4.0
        return pickle.dumps((np.empty(0, np.uint64), np.empty(0, np.float32), bias))
    keys, counts = np.unique(np.concatenate(rows), return_counts=True)
    keys = keys[counts >= MIN_ROWS]
    places = []
    for row in rows:
        at = np.minimum(np.searchsorted(keys, row), max(0, len(keys) - 1))
        places.append(at[keys[at] == row] if len(keys) else at[:0])
    model = Ftrl(len(keys))
    order = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in order.permutation(len(places)):
            model.update(places[i], labels[i])
    weights = model.weights(np.arange(len(keys)))
    kept = weights != 0
    return pickle.dumps((keys[kept], weights[kept].astype(np.float32), float(model.bias())))


def train(
    docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> bytes:
    """Fit on at most about ``rows_per_label`` rows of each label; other labels than 0 and 1 are ignored."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    return fit_in_task(training_rows(docs, known, rows_per_label, seed, id_col, text_col), fit)


def score_texts(texts: pd.Series, model: tuple, hashes: dict) -> pd.Series:
    keys, weights, bias = model
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        total = bias
        if len(keys) and text:
            row = features(text, hashes)
            at = np.minimum(np.searchsorted(keys, row), len(keys) - 1)
            total += weights[at[keys[at] == row]].sum(dtype=np.float64)
        out[i] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
    return pd.Series(out)


def scorer(spark: SparkSession, model: bytes) -> Callable:
    """Column function: text to a score between 0 and 1. Null and empty texts get the bias."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        loaded, hashes = pickle.loads(shared.value), WordHashes()
        for texts in batches:
            yield score_texts(texts, loaded, hashes)

    return score


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **training
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts get a score as well. A null id counts as not held out and is never
    learned from. An empty table gives an empty result.
    """
    score = scorer(docs.sparkSession, train(docs, labels, id_col=id_col, text_col=text_col, **training))
    scored = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col)).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    """Rows of ``docs`` that the model does not reject, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels, **training))
    return docs.where(score(F.col("text")) < 0.5)
