"""Joins, rankings and top-k that stay balanced when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.session import materialise

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
NULL_SALTS = 1024
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

_RUN_BITS = 33


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows per key; partial counts keep the shuffle at one row per key and task."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))


def hot_keys(counts: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with at least ``hot_rows`` rows and the number of tasks for each; None if there are none.

    Looked up once, here: ``MAX_HOT_KEYS`` bounds the list whatever the table size, and a key
    beyond it is merely joined like any other.
    """
    salts = F.ceil(F.col("n_rows") / F.lit(hot_rows)).cast("int").alias("_salts")
    largest = (
        counts.where(F.col("n_rows") >= hot_rows).orderBy(F.desc("n_rows")).limit(MAX_HOT_KEYS)
    ).select(*on, salts)
    found = largest.collect()
    return F.broadcast(counts.sparkSession.createDataFrame(found, largest.schema)) if found else None


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join in which the rows of a hot left key go to several tasks.

    ``right`` holds each key once, or few times. ``counts`` (``on`` + ``n_rows``) gives the
    rows per left key. Without a hot key this is the plain join. The result never depends on
    the salt. Left rows with a null key match nothing; where they are many they are spread
    evenly too.
    """
    counts = key_counts(left, on) if counts is None else counts
    hot = hot_keys(counts, on, hot_rows)
    if hot is None:
        return left.join(right, list(on), how)
    slot = F.xxhash64(*spread)
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    salted_left = left.join(hot, list(on), "left").withColumn(
        "_salt",
        F.when(no_key, F.pmod(slot, F.lit(NULL_SALTS)))
        .when(F.col("_salts").isNotNull(), F.pmod(slot, F.col("_salts")))
        .otherwise(F.lit(0))
        .cast("int"),
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_right = (
        right.join(hot, list(on), "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    )
    return salted_left.drop("_salts").join(salted_right, [*on, "_salt"], how).drop("_salt")


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Mark ``df`` for broadcast when its rows and bytes are within bounds, else leave it alone.

    The check looks at no more than ``max_rows + 1`` rows of ``probe``, a frame at least as
    large as ``df`` that is cheaper to read (``df`` itself if not given).
    """
    probe = df if probe is None else probe
    width = F.lit(0)
    for name in probe.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    found = probe.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return F.broadcast(df) if found.n <= max_rows and (found.b or 0) <= max_bytes else df


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    spread: Sequence[str],
    salts: int = 32,
) -> DataFrame:
    """First ``k`` rows per key, chosen in slices of each key and then among the slice winners.

    No task ever ranks more than a slice of a key, or ``salts * k`` winners.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    in_key = Window.partitionBy(*keys).orderBy(*order)
    winners = sliced.withColumn("_rn", F.row_number().over(in_slice)).where(F.col("_rn") <= k)
    return (
        winners.withColumn("_rn", F.row_number().over(in_key))
        .where(F.col("_rn") <= k)
        .drop("_rn", "_slice")
    )


def _sorted_runs(df: DataFrame, columns: Sequence[str], partitions: int | None) -> DataFrame:
    """Rows with ``_run`` (sorted slice number) and ``_idx`` (place in the slice).

    Range partitioning splits a key that is too big for a slice, since ``columns`` together
    are unique. The result is written out: slice bounds come from a sample and must not be
    drawn twice.
    """
    spread = (
        df.repartitionByRange(*columns)
        if partitions is None
        else df.repartitionByRange(partitions, *columns)
    )
    place = spread.sortWithinPartitions(*columns).withColumn("_at", F.monotonically_increasing_id())
    runs = place.select(
        *df.columns,
        F.shiftright("_at", _RUN_BITS).cast("int").alias("_run"),
        F.col("_at").bitwiseAND(F.lit((1 << _RUN_BITS) - 1)).alias("_idx"),
    )
    return materialise(runs, "runs")


def _join_runs(rows: DataFrame, per_run: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on run and keys, null keys included."""
    names = {key: f"_key{i}" for i, key in enumerate(keys)}
    right = per_run.withColumnsRenamed({**names, "_run": "_of_run"})
    same = F.col("_run") == F.col("_of_run")
    for key, name in names.items():
        same = same & F.col(key).eqNullSafe(F.col(name))
    return rows.join(right, same).drop("_of_run", *names.values())


def global_rank(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add ``rank`` (1, 2, ...) over the whole table; ``order`` must be unique.

    Only the slice sizes are gathered in one place: as many rows as there are slices.
    """
    runs = _sorted_runs(df, order, partitions)
    sizes = runs.groupBy("_run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return runs.join(F.broadcast(offsets), "_run").select(
        *df.columns, (F.col("_before") + F.col("_idx") + 1).alias("rank")
    )


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Add ``rank`` within ``keys``; ``keys`` + ``order`` must be unique. Null is a key of its own."""
    runs = _sorted_runs(df, [*keys, *order], partitions)
    sizes = runs.groupBy("_run", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_idx").alias("_first")
    )
    before = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return _join_runs(runs, offsets, keys).select(
        *df.columns, (F.col("_before") + F.col("_idx") - F.col("_first") + 1).alias("rank")
    )


def lag_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alias: str,
    partitions: int | None = None,
) -> DataFrame:
    """Add the previous ``value`` within ``keys``, looking across slice borders where needed."""
    runs = _sorted_runs(df, [*keys, *order], partitions)
    ends = runs.groupBy("_run", *keys).agg(
        F.min("_idx").alias("_first"), F.max_by(F.col(value), F.col("_idx")).alias("_last")
    )
    across = Window.partitionBy(*keys).orderBy("_run")
    borders = ends.select("_run", *keys, "_first", F.lag("_last").over(across).alias("_carried"))
    inside = Window.partitionBy("_run", *keys).orderBy("_idx")
    local = runs.withColumn("_local", F.lag(value).over(inside))
    previous = F.when(F.col("_idx") == F.col("_first"), F.col("_carried")).otherwise(F.col("_local"))
    return _join_runs(local, borders, keys).select(*df.columns, previous.alias(alias))
