"""Spelling variant grouping over an index of variable-length grams.

Words become grams of three to five characters: a gram grows while it is frequent in the
vocabulary, so that lists of words that share a gram stay short. For every place an edit can be
at, the grams it can affect are known; a word merges its lists in order of rarity until every
edit leaves one of them untouched. Two near words so meet in a list that both merge, and pairs
that meet are verified. Words too short for that are indexed once more by grams of fixed length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import bounded_batches, mix64
from presswork.session import materialise

MIN_LENGTH = 5
MIN_COUNT = 3
SLIP = 97
RATIO = 2
SHORTEST_GRAM = 3
LONGEST_GRAM = 5
#: Grams of the dictionary at most; the frequency a gram needs to be in it follows from this.
MAX_GRAMS = 500_000
MIN_FREQUENCY = 300
WORDS_PER_BATCH = 20_000
#: Distinct words a task counts before it sends them on.
TASK_WORDS = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int64(1) << 40


class GramDictionary:
    """Grams that occur more often than ``above`` in the vocabulary, packed a byte a character."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, shortest: int, longest: int):
        order = np.argsort(grams)
        self.grams, self.counts = grams[order], counts[order]
        self.shortest, self.longest = shortest, longest

    def frequency(self, codes: np.ndarray) -> np.ndarray:
        """Count of each packed gram, 0 for those that are not frequent."""
        if not len(self.grams):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        return np.where(self.grams[at] == codes, self.counts[at], 0)


def flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters in a row, every word between two marks, and where each word begins and ends."""
    data = np.frombuffer("".join(f"\x01{w}\x02" for w in words).encode("latin-1"), np.uint8).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(w) + 2 for w in words])]).astype(np.int64)
    return data, bounds


def packed(data: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` characters from each place on as one number (wrong beyond the last word)."""
    out = np.zeros(len(data), np.int64)
    for k in range(length):
        out = (out << 8) | np.concatenate([data[k:], np.zeros(min(k, len(data)), np.int64)])
    return out


def grams(data: np.ndarray, bounds: np.ndarray, known: GramDictionary) -> tuple[np.ndarray, np.ndarray]:
    """Length and packed code of the gram at each place, 0 where the word has no room for one."""
    room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
    codes = packed(data, known.shortest)
    size = np.where(room >= known.shortest, known.shortest, 0)
    for q in range(known.shortest, known.longest):
        longer = (size == q) & (room > q)
        at = np.flatnonzero(longer)
        at = at[known.frequency(codes[at]) > 0]
        size[at] = q + 1
        codes[at] = (codes[at] << 8) | data[at + q]
    return size, np.where(size > 0, codes, 0)


def index_keys(words: list[str], known: GramDictionary, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the lists each word merges: ``word number, key, open``.

    A gram gives two keys, by its distance from the start and from the end of the word: an edit
    behind it keeps the first, one before it the second. A gram that others contain is no gram
    of the word. Replacing the character at i affects, besides the grams over i, those behind it
    that a gram grown across i could contain: such a gram would have grown over all up to its
    last character, and none longer than the gram at i + 1 can have. An inserted character
    affects no more than replacing the one before it.

    Keys are taken in order of gram frequency up to the least key that the worst edit leaves.
    ``open`` words have edits that may leave none and give all their keys; two near words meet
    unless both are open.
    """
    data, bounds = flat(words)
    size, codes = grams(data, bounds, known)
    place = np.arange(len(data))
    word = np.repeat(np.arange(len(words)), np.diff(bounds))
    end = place + size
    reach = np.maximum.accumulate(end)
    own = (size > 0) & (end > np.concatenate([[0], reach[:-1]]))
    start, stop, code, of = place[own], end[own], codes[own], word[own]

    common = np.minimum(known.frequency(code), (1 << 19) - 1) << 20
    keys, orders = [], []
    for side, offset in ((0, start - bounds[of]), (1, bounds[of + 1] - start)):
        salt = np.uint64((2 * level + side + 1) * int(_STEP) % 2**64)
        key = mix64(mix64(code.view(np.uint64) + salt) + offset.astype(np.uint64) * _STEP)
        keys.append(key.view(np.int64))
        orders.append(common | (key & np.uint64((1 << 20) - 1)).astype(np.int64))
    # Least order up to a gram, and from a gram on, within its word.
    apart = of * _NONE
    least_before = np.minimum.accumulate(orders[0] - apart) + apart
    least_behind = np.minimum.accumulate((orders[1] + apart)[::-1])[::-1] - apart

    edit = np.flatnonzero(place < np.repeat(bounds[1:], np.diff(bounds)) - 1)
    best = np.full(len(edit), _NONE)
    last = np.searchsorted(stop, edit, "right") - 1
    held = (last >= 0) & (of[np.maximum(last, 0)] == word[edit]) if len(of) else np.zeros(len(edit), bool)
    best[held] = least_before[last[held]]
    if len(of):
        free = np.minimum(end[edit + 1] + 1, edit + known.longest + 1)
        first = np.maximum(np.searchsorted(stop, free), np.searchsorted(start, edit + 1))
        inside = np.minimum(first, len(of) - 1)
        held = (first < len(of)) & (of[inside] == word[edit]) & (size[edit + 1] > 0)
        best[held] = np.minimum(best[held], least_behind[inside[held]])
    worst = np.full(len(words), -1, np.int64)
    np.maximum.at(worst, word[edit], best)
    taken = [order <= worst[of] for order in orders]
    number = np.concatenate([of[t] for t in taken])
    return number, np.concatenate([k[t] for k, t in zip(keys, taken)]), worst >= _NONE


def occurrences(text: str | None, doc_id: int | None, min_length: int = MIN_LENGTH, slip: int = SLIP) -> list[bytes]:
    """Runs of letters of at least ``min_length`` code points, slips of the pen included, in UTF-8.

    Where ``slip`` divides the crc32 of "id:run" the run loses the code point at crc32 % length.
    """
    data = (text or "").encode().lower()
    letters = b"[a-z]" if data.isascii() else b"(?:[a-z]|\xc3[\x80-\xbf])"
    found = re.findall(b"%s{%d,}" % (letters, min_length), data)
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    sums = np.fromiter(map(crc32, found, repeat(start)), np.int64, len(found))
    lost = []
    for k in np.flatnonzero(sums % slip == 0).tolist():
        run = found[k].decode()
        at = int(sums[k]) % len(run)
        found[k] = (run[:at] + run[at + 1 :]).encode()
        if len(run) <= min_length:
            lost.append(k)
    for k in reversed(lost):
        del found[k]
    return found


def vocabulary(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slip: int = SLIP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, n`` of all words with at least ``min_count`` occurrences.

    Tasks count first, at most ``TASK_WORDS`` words at a time, and send each word once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            words = pa.array([w.decode() for w in counts], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.update(occurrences(text.as_py(), doc_id, min_length, slip))
                if len(counts) >= TASK_WORDS:
                    yield rows()
                    counts.clear()
        yield rows()

    bounded_batches(docs.sparkSession)
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = found.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], pa.RecordBatch]]:
    for batch in batches:
        for at in range(0, batch.num_rows, WORDS_PER_BATCH):
            part = batch.slice(at, WORDS_PER_BATCH)
            yield part.column(0).to_pylist(), part


def gram_dictionary(
    words: DataFrame, shortest: int, longest: int, max_grams: int, min_frequency: int
) -> GramDictionary:
    """Frequent grams of ``word``, length by length; only those of frequent beginnings are counted.

    A length has as many grams as the words have characters, so fewer than characters / t of
    them occur more than t times: t is chosen so that all lengths together stay below
    ``max_grams``.
    """
    chars = words.agg(F.sum(F.char_length("word") + 2)).first()[0] or 0
    above = max(min_frequency, -(-chars * (longest - shortest + 1) // max_grams))
    known = GramDictionary(np.empty(0, np.int64), np.empty(0, np.int64), shortest, longest)
    for q in range(shortest, longest + 1):
        before = known

        def count(batches: Iterator[pa.RecordBatch], q=q, before=before) -> Iterator[pa.RecordBatch]:
            for part, _ in _word_batches(batches):
                data, bounds = flat(part)
                whole = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data)) >= q
                codes = packed(data, q)[whole]
                if q > before.shortest:
                    codes = codes[before.frequency(codes >> 8) > 0]
                found, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["gram", "n"])

        counts = words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        rows = counts.where(F.col("n") > above).toPandas()
        known = GramDictionary(
            np.concatenate([known.grams, rows["gram"].to_numpy(np.int64)]),
            np.concatenate([known.counts, rows["n"].to_numpy(np.int64)]),
            shortest, longest,
        )
        if rows.empty:
            break
    return known


def near_words(
    words: DataFrame,
    shortest: int = SHORTEST_GRAM,
    longest: int = LONGEST_GRAM,
    max_grams: int = MAX_GRAMS,
    min_frequency: int = MIN_FREQUENCY,
) -> DataFrame:
    """``a, na, b, nb``: pairs of ``word, n`` that differ by one inserted, deleted or replaced
    code point, each pair once, ``a`` before ``b``.

    Words are distinct and of code points up to U+00FF without control characters, at least
    ``shortest`` + 1 long; ``longest`` is 7 at most.
    """
    bounded_batches(words.sparkSession, WORDS_PER_BATCH)
    known = gram_dictionary(words, shortest, longest, max_grams, min_frequency)
    fixed = GramDictionary(known.grams, known.counts, shortest, shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _word_batches(batches):
            number, key, is_open = index_keys(part, known, 0)
            late = np.flatnonzero(is_open)
            if len(late):
                again, more, _ = index_keys([part[k] for k in late], fixed, 1)
                number, key = np.concatenate([number, late[again]]), np.concatenate([key, more])
            columns = [pa.array(key), rows.column(0).take(pa.array(number)), rows.column(1).take(pa.array(number))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "word", "n"])

    keyed = words.select("word", "n").mapInArrow(run, "key long, word string, n long")
    keyed = materialise(keyed.withColumn("size", F.char_length("word")), "word-keys")
    left = keyed.select("key", F.col("word").alias("a"), F.col("n").alias("na"), F.col("size").alias("sa"))
    right = keyed.select("key", F.col("word").alias("b"), F.col("n").alias("nb"), F.col("size").alias("sb"))
    near = (F.abs(F.col("sa") - F.col("sb")) <= 1) & (F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1)
    met = left.join(right.hint("merge"), (left["key"] == right["key"]) & near)
    return met.select("a", "na", "b", "nb").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms are followed to the last by doubling the steps.

    A form is at least twice as frequent as its word, so chains are short.
    """
    steps = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        doubled = steps.join(ahead, "root", "left")
        doubled = materialise(doubled.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        steps = doubled.select("word", "root")
        if doubled.where("next IS NOT NULL").isEmpty():
            return steps


def _best(n: Column, word: Column) -> Column:
    """Least value: largest ``n`` first, then by code point."""
    return F.min(F.struct((-n).alias("less"), word.alias("form")))


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, **options
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word of ``vocabulary``.

    ``form`` is the near word with the largest count, the first by code point among equals, if
    it is at least ``ratio`` times as frequent; else null. ``root`` follows forms to the last.
    Null and empty texts have no words; a null id reads as no digits; repeated rows count as
    often as they are there. No words give an empty result. ``min_length`` is 4 at least.
    """
    if min_length <= SHORTEST_GRAM:
        raise ValueError(f"min_length must be above {SHORTEST_GRAM}")
    bounded_batches(docs.sparkSession, WORDS_PER_BATCH)
    words = materialise(vocabulary(docs, min_length, min_count, **options), "words")
    pairs = materialise(near_words(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m"))
    )
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), _best(F.col("m"), F.col("other")).alias("best"))
    known = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    is_form = F.col("form_n") >= ratio * F.col("n")
    known = known.select(
        "word",
        F.when(is_form, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    known = materialise(known, "forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
