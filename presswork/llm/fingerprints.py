"""Document fingerprints of Lempel-Ziv phrases.

A document is parsed into phrases, each the longest phrase known so far and one character more.
The set of phrases is hashed and its smallest hashes are the fingerprint; the share of hashes
that two fingerprints have in common among the smallest of both estimates the likeness of the
phrase sets, and so how well one text would compress the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from presswork.llm.common import bounded_batches

#: Hashes of a fingerprint, 8 hexadecimal digits each.
HASHES = 128
#: Rows of a run of neighbouring documents, and the most runs there are.
RUN_ROWS = 1024
MAX_RUNS = 10_000


def parse(text: str, seen: set[str], start: int = 0) -> int:
    """Add the phrases of ``text`` from ``start`` on to ``seen``; where the unfinished rest begins.

    Every beginning of a known phrase is known, so the length of the longest one is searched
    from the length of the phrase before, up or down.
    """
    end, size = len(text), 1
    while start < end:
        while start + size <= end and text[start : start + size] in seen:
            size += 1
        while size > 1 and text[start : start + size - 1] not in seen:
            size -= 1
        if start + size > end:
            break
        seen.add(text[start : start + size])
        start += size
    return start


def smallest(phrases: set[str], known: np.ndarray | None = None, hashes: int = HASHES) -> np.ndarray:
    """The smallest distinct 32-bit hashes of ``phrases`` and of the hashes ``known``, sorted."""
    found = np.fromiter(map(xxhash.xxh32_intdigest, phrases), np.uint32, len(phrases))
    if known is not None:
        found = np.concatenate([found, known])
    if len(found) > 4 * hashes:
        # Repeats are rare, so four times as many rows hold enough distinct ones; else all are sorted.
        few = np.unique(np.partition(found, 4 * hashes)[: 4 * hashes])
        if len(few) >= hashes:
            return few[:hashes]
    return np.unique(found)[:hashes]


def fingerprint(text: str | None, hashes: int = HASHES) -> np.ndarray:
    seen: set[str] = set()
    parse(text or "", seen)
    return smallest(seen, None, hashes)


def written(print_: np.ndarray) -> str:
    return print_.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, hashes: int = HASHES) -> float:
    """Estimated share of common phrases, exact for sets that fit a fingerprint; two empty texts
    are alike, an empty and another one are not."""
    if not len(a) and not len(b):
        return 1.0
    lowest = np.union1d(a, b)[:hashes]
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), lowest, assume_unique=True)) / len(lowest)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``, or all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


class _Parsed(NamedTuple):
    run: int
    doc_id: int | None
    text: str
    cut: int
    common: set[str]
    common_print: np.ndarray
    print_: np.ndarray


def _parsed(run: int, doc_id: int | None, text: str | None, hashes: int) -> _Parsed:
    """Phrases of the first two thirds, which the edited text shares, and of the whole text."""
    text = text or ""
    common: set[str] = set()
    cut = parse(text[: len(text) - len(text) // 3], common)
    shared = smallest(common, None, hashes)
    whole = set(common)
    parse(text, whole, cut)
    return _Parsed(run, doc_id, text, cut, common, shared, smallest(whole - common, shared, hashes))


def _runs(docs: DataFrame, run_rows: int, max_runs: int) -> tuple[DataFrame, int]:
    """Rows of ``docs`` with ``run`` and ``guest``: runs of neighbours by descending id, each
    followed by the first document of the next run as its guest."""
    spark = docs.sparkSession
    count = docs.count()
    n_runs = max(1, min(max_runs, -(-count // run_rows)))
    bounds = []
    if n_runs > 1:
        shares = [k / n_runs for k in range(1, n_runs)]
        bounds = docs.agg(F.percentile_approx("doc_id", shares, 100_000).alias("b")).first().b or []
        bounds = sorted(set(bounds))
    above = F.aggregate(F.lit(bounds).cast("array<long>"), F.lit(0), lambda n, b: n + (F.col("doc_id") <= b).cast("int"))
    run = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(above) if bounds else F.lit(0)
    placed = docs.withColumn("run", run.cast("int")).withColumn("tie", F.xxhash64("text"))
    # The first row of each run: at most ``max_runs`` and two, of two numbers.
    first = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", F.bitwise_not("tie").alias("back"))
    heads = [(r.run, r.first.doc_id, ~r.first.back) for r in placed.groupBy("run").agg(F.max(first).alias("first")).collect()]
    heads.sort()
    before = [(doc_id, tie, heads[k - 1][0]) for k, (_, doc_id, tie) in enumerate(heads)]
    schema = StructType([StructField(name, LongType()) for name in ("head_id", "head_tie", "before")])
    ends = F.broadcast(spark.createDataFrame(before, schema))
    is_head = placed["doc_id"].eqNullSafe(ends["head_id"]) & (placed["tie"] == ends["head_tie"])
    own = F.struct(F.col("run"), F.lit(False).alias("guest"))
    also = F.struct(F.col("before").cast("int").alias("run"), F.lit(True).alias("guest"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, also))
    dealt = placed.join(ends, is_head, "left").select("doc_id", "text", "tie", F.inline(places))
    return dealt, len(heads)


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hashes: int = HASHES,
    run_rows: int = RUN_ROWS,
    max_runs: int = MAX_RUNS,
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one with the next smaller id, after the last the first; rows that
    share an id follow each other by a hash of their text, rows without an id come last. A null
    text is empty and has an empty fingerprint. Repeated rows come as often as they are there; a
    single document is its own next one. An empty table gives an empty result.

    Texts are shuffled once, into runs of neighbours that a task reads in order, a document and
    its successor at a time; a very long text is held whole, with its phrases.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt, n_runs = _runs(rows, run_rows, max_runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Parsed | None = None
        for batch in batches:
            out = []
            for at, guest, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if guest and (held is None or held.run != at):
                    continue
                here = _parsed(at, doc_id, text, hashes)
                if held is not None and held.run == at:
                    out.append(_finished(held, here, hashes))
                held = None if guest else here
            if out:
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, _KINDS.values())], names=list(_KINDS)
                )

    ordered = dealt.repartition(max(1, n_runs), "run").sortWithinPartitions(
        "run", "guest", F.col("doc_id").desc_nulls_last(), "tie"
    )
    return ordered.select("run", "guest", "doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


_KINDS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}


def _finished(held: _Parsed, following: _Parsed, hashes: int) -> tuple:
    edited = edited_text(held.text, following.text)
    phrases = set(held.common)
    parse(edited, phrases, held.cut)
    edited_print = smallest(phrases - held.common, held.common_print, hashes)
    return (
        held.doc_id, len(held.text), hashlib.sha256(edited.encode()).hexdigest(), written(held.print_), written(edited_print),
        likeness(held.print_, edited_print, hashes), likeness(held.print_, following.print_, hashes),
    )
