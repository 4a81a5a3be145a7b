"""Main text of pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A block is described by its ancestors' tags and purposes and by the shape of its text. The
field is trained by gradient ascent on labelled pages; Viterbi finds the best labelling.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import bounded_batches
from presswork.llm.html_blocks import Block, blocks
from presswork.llm.html_training import labelled_pages

EPOCHS = 150
RATE = 0.5
DECAY = 0.02


def features(block: Block) -> tuple:
    text, size = block.text, len(block.text)
    words = text.count(" ") + 1
    shape = (
        f"words={min(words.bit_length(), 6)}",
        f"linked={min(3, 4 * block.in_links // max(1, size))}",
        f"commas={min(2, text.count(','))}",
        f"end={text[-1] in '.!?:'}",
        f"mark={'©' in text}",
    )
    return (*sorted(block.marks), *shape, "any" if block.marks else "bare")


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradient(scores: np.ndarray, step: np.ndarray, labels: np.ndarray, there: np.ndarray):
    """Observed minus expected label counts per block and per label pair, for all pages at once.

    ``scores`` is pages x blocks x 2, short pages padded; ``there`` marks the real blocks.
    """
    n_pages, n, _ = scores.shape
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, n):
        new = scores[:, t] + _log_sum(ahead[:, t - 1, :, None] + step, 1)
        ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
    for t in range(n - 2, -1, -1):
        new = _log_sum(step + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(there[:, t + 1, None], new, 0)
    whole = _log_sum(ahead[:, -1], 1)
    observed = np.eye(2)[labels]
    by_block = (observed - np.exp(ahead + back - whole[:, None, None])) * there[:, :, None]
    pairs = ahead[:, :-1, :, None] + step + (scores + back)[:, 1:, None, :] - whole[:, None, None, None]
    both = observed[:, :-1, :, None] * observed[:, 1:, None, :]
    by_pair = ((both - np.exp(np.minimum(pairs, 0))) * there[:, 1:, None, None]).sum(axis=(0, 1))
    return by_block, by_pair


def train(pages: list[tuple[list[Block], list[int]]] | None = None) -> bytes:
    """Adagrad over labelled pages; returns (feature weights, transitions), pickled."""
    pages = labelled_pages() if pages is None else pages
    pages = [(page, labels) for page, labels in pages if page]
    n = max(len(page) for page, _ in pages)
    names: dict[str, int] = {}
    labels, there = np.zeros((len(pages), n), int), np.zeros((len(pages), n), bool)
    block_of, feature_of = [], []
    for k, (page, wanted) in enumerate(pages):
        labels[k, : len(page)], there[k, : len(page)] = wanted, True
        for t, block in enumerate(page):
            for name in features(block):
                block_of.append(k * n + t)
                feature_of.append(names.setdefault(name, len(names)))
    block_of, feature_of = np.array(block_of), np.array(feature_of)
    emit, step = np.zeros((len(names), 2)), np.zeros((2, 2))
    seen_emit, seen_step = np.full(emit.shape, 1e-6), np.full((2, 2), 1e-6)

    def sums(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(at, values[:, label], size) for label in (0, 1)], axis=1)

    for _ in range(EPOCHS):
        scores = sums(emit[feature_of], block_of, len(pages) * n).reshape(len(pages), n, 2)
        by_block, by_pair = _gradient(scores, step, labels, there)
        by_emit = sums(by_block.reshape(-1, 2)[block_of], feature_of, len(names)) - DECAY * emit
        by_step = by_pair - DECAY * step
        seen_emit += by_emit**2
        seen_step += by_step**2
        emit += RATE * by_emit / np.sqrt(seen_emit)
        step += RATE * by_step / np.sqrt(seen_step)
    return pickle.dumps(({name: tuple(emit[k].tolist()) for name, k in names.items()}, step.tolist()))


@lru_cache(1)
def _default_model() -> bytes:
    return train()


class Labeller:
    """Viterbi decoding; the score of a feature set is worked out once per task."""

    def __init__(self, model: bytes):
        self.weights, self.step = pickle.loads(model)
        self.known: dict[tuple, tuple[float, float]] = {}

    def _score(self, block: Block) -> tuple[float, float]:
        key = features(block)
        found = self.known.get(key)
        if found is None:
            pairs = [self.weights[name] for name in key if name in self.weights]
            found = (sum(p[0] for p in pairs), sum(p[1] for p in pairs))
            if len(self.known) < 100_000:
                self.known[key] = found
        return found

    def labels(self, page: list[Block]) -> list[int]:
        if not page:
            return []
        (s00, s01), (s10, s11) = self.step
        a, b = self._score(page[0])
        came: list[tuple[int, int]] = []
        for block in page[1:]:
            x, y = self._score(block)
            from0, from1 = int(b + s10 > a + s00), int(b + s11 > a + s01)
            came.append((from0, from1))
            a, b = x + (b + s10 if from0 else a + s00), y + (b + s11 if from1 else a + s01)
        label = int(b > a)
        out = [label]
        for pair in reversed(came):
            label = pair[label]
            out.append(label)
        return out[::-1]

    def text(self, page: str | None) -> str:
        found = blocks(page)
        return " ".join(block.text for block, label in zip(found, self.labels(found)) if label)


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: bytes | None = None
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; null, empty and textless pages give "".

    The model is a few hundred weights, trained on the driver from labelled pages built by rule
    unless one is given. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    model = _default_model() if model is None else model

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller = Labeller(model)
        for batch in batches:
            yield pd.Series([labeller.text(page) for page in batch], dtype=object)

    found = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), extract(F.col(html_col)).alias("text")
    )
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
