"""Helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.skew import broadcast_if_small
from presswork.session import discard, materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words are runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 512
CACHED_WORDS = 500_000
SMALL_ROWS = 1_000_000
SMALL_BYTES = 8 * 1024 * 1024


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of texts small: ``rows`` rows at most, whatever the session says."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Rows kept out of all training: crc32 of the id as text divides by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted size is within ``SMALL_BYTES``, and ``SMALL_ROWS``."""
    return broadcast_if_small(df, SMALL_ROWS, SMALL_BYTES)


class WordHashes(dict):
    """64-bit hash of each word; the commonest words of a task stay at hand."""

    def __missing__(self, word: str | bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: ``(node, component)`` for all but the smallest.

    ``links`` has the long columns ``a`` and ``b``. Alternates "point larger neighbours at the
    smallest one" and "point smaller neighbours at it" until only stars are left, in about the
    logarithm of the longest path. Each round is a written table, so a lost executor repeats
    tasks and not rounds; minima are written before the join that reads them, which lets
    adaptive execution split the rows of a node with very many neighbours.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialise(edges.distinct(), "links")
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        lowest = materialise(lowest.select(F.col("a").alias("b"), F.least("a", "m").alias("m")), "lowest")
        larger = edges.join(lowest, "b").select("a", F.col("m").alias("b")).where("a <> b").distinct()
        larger = materialise(larger, "larger")
        done = [edges, lowest, larger]
        lowest = materialise(larger.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        smaller = larger.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = smaller.where("a <> b").unionByName(lowest.select("a", F.col("m").alias("b")))
        edges = materialise(stars.distinct(), "links")
        discard(*done, lowest)
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
