"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean embedding of the character n-grams inside its words. Embeddings and softmax
are trained together by stochastic gradient descent. Since everything between them is linear,
prediction needs only the product of the two: one row of language scores per bucket.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import bounded_batches, held_out, mix64
from presswork.llm.training import fit_in_task, training_rows

#: Bound of the training sample: about so many rows of each language.
ROWS_PER_LANG = 1_200
BUCKETS = 1 << 16
DIM = 16
EPOCHS = 6
RATE = 0.5
GRAMS = (2, 3, 4)
#: Predictions are accepted from the score at which so many of the calibration rows are right.
PRECISION = 0.99
UNKNOWN = "und"
_LETTER = r"[\p{L}\p{M}]"
_SPACE = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def letters() -> np.ndarray:
    """Which code points are letters or marks."""
    known = np.zeros(sys.maxunicode + 1, bool)
    known[[ord(c) for c in regex.findall(_LETTER, "".join(map(chr, range(len(known)))))]] = True
    return known


def _words(text: str, known: np.ndarray) -> np.ndarray:
    """Code points of the words of a text, lower-cased, with one blank before and after each."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = known[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    return np.where(letter, codes, np.uint32(_SPACE))[kept]


def subwords(text: str | None, known: np.ndarray | None = None) -> np.ndarray:
    """Bucket of every 2-, 3- and 4-gram of a whole text; none reaches across a word's border.

    Words are runs of letters, lower-cased, with a blank for their start and end. ``known`` is
    the table of ``letters``; callers with many texts make it once.
    """
    codes = _words(text, letters() if known is None else known) if text else np.empty(0, np.uint32)
    if len(codes) < 2:
        return np.empty(0, np.int64)
    inner = codes != _SPACE
    codes = codes.astype(np.uint64)
    found = []
    for size in GRAMS:
        if len(codes) < size:
            continue
        n = len(codes) - size + 1
        total, whole = np.full(n, size, np.uint64), np.ones(n, bool)
        for k in range(size):
            total = total * _STEP + codes[k : k + n]
            if 0 < k < size - 1:
                whole &= inner[k : k + n]
        if size == 2:
            whole = inner[:n] | inner[1 : n + 1]
        found.append((mix64(total[whole]) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(found)


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return scores / scores.sum(axis=-1, keepdims=True)


def _mean_scores(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.take(table, at, axis=0).mean(axis=0)


def _calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Temperature of least log loss, and the score from which accepted rows are right."""
    if not len(scores):
        return 1.0, 0.0
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    best = float(grid[int(np.argmin(loss))])
    odds = _softmax(scores / best)
    top, right = odds.max(axis=1), odds.argmax(axis=1) == labels
    order = np.argsort(-top, kind="stable")
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION
    return best, float(top[order][np.nonzero(precise)[0][-1]]) if precise.any() else 1.0


def fit(batches: Iterator[pd.DataFrame]) -> bytes:
    """Model of a bounded sample with columns ``text, label``; one row in five calibrates it.

    Every row also gives a snippet of a few of its words, so that short texts are known too.
    Without rows the model knows no language.
    """
    draw, rows, names, known = np.random.default_rng(5), [], [], letters()
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            words = text.split()
            start = int(draw.integers(0, max(1, len(words) - 4)))
            for piece in (text, " ".join(words[start : start + int(draw.integers(1, 9))])):
                at = subwords(piece, known)
                if len(at):
                    rows.append(np.unique(at, return_counts=True))
                    names.append(label)
    langs = sorted(set(names))
    if not langs:
        return pickle.dumps(([], np.zeros((BUCKETS, 0), np.float32), 1.0, 0.0))
    labels = np.searchsorted(langs, names)
    held = draw.random(len(rows)) < 0.2
    embed = draw.uniform(-1, 1, (BUCKETS, DIM)) / DIM
    weights = np.zeros((DIM, len(langs)))
    learned = np.nonzero(~held)[0]
    steps, total = 0, EPOCHS * max(1, len(learned))
    for _ in range(EPOCHS):
        for i in draw.permutation(learned):
            at, times = rows[i]
            share = times / times.sum()
            mean = share @ embed[at]
            gradient = _softmax(mean @ weights)
            gradient[labels[i]] -= 1
            rate = RATE * (1 - steps / total)
            back = weights @ gradient
            weights -= rate * np.outer(mean, gradient)
            embed[at] -= (rate * DIM) * share[:, None] * back[None, :]
            steps += 1
    table = embed @ weights
    scores = [(rows[i][1] @ table[rows[i][0]]) / rows[i][1].sum() for i in np.nonzero(held)[0]]
    temperature, least = _calibrate(np.array(scores).reshape(-1, len(langs)), labels[held])
    return pickle.dumps((langs, table.astype(np.float32), temperature, least))


def train(
    docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG, seed: int = 9,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> bytes:
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("label"))
    known = known.where("label IS NOT NULL").groupBy("id").agg(F.min("label").alias("label"))
    return fit_in_task(training_rows(docs, known, rows_per_lang, seed, id_col, text_col), fit)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **training
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the text is null or has no
    letter, or nothing was learned. ``rejected`` marks predictions whose calibrated probability
    is below the bound found on calibration rows. Learns only from rows with a language whose
    crc32 of the id does not divide by five. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    model = train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **training)
    # The letters go along as bits, so that no task has to look them up.
    shared = spark.sparkContext.broadcast((model, np.packbits(letters())))
    bounded_batches(spark)

    @F.pandas_udf("struct<lang_pred string, score double, rejected boolean>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, bits = shared.value
        langs, table, temperature, least = pickle.loads(model)
        known = np.unpackbits(bits)[: sys.maxunicode + 1].astype(bool)
        for texts in batches:
            names, scores, rejected = [], [], []
            for text in texts:
                # Marks alone are no letters.
                at = subwords(text, known) if langs and any(map(str.isalpha, text or "")) else ()
                if not len(at):
                    names.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                odds = _softmax(_mean_scores(table, at).astype(np.float64) / temperature)
                best = int(odds.argmax())
                names.append(langs[best]), scores.append(float(odds[best])), rejected.append(odds[best] < least)
            yield pd.DataFrame({"lang_pred": names, "score": scores, "rejected": rejected})

    found = docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.*")
