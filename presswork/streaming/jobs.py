"""Continuous ingest, score application and daily trend.

Each stream hands its micro-batches to the functions of the batch jobs. Replaying a batch
changes nothing: inserts are anti-joined with the stored rows, scored articles are skipped
and trend rows are keyed by batch number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from presswork import settings as S
from presswork.functions.text import strip
from presswork.operators import dedup, feed, skew
from presswork.plans import jobs
from presswork.session import materialise
from presswork.sources import tables
from presswork.streaming.held import HeldRows


def read_files(spark, path: str, schema: StructType, kind: str = "parquet", **options) -> DataFrame:
    """Stream over the files that arrive under ``path``."""
    return spark.readStream.schema(schema).format(kind).options(**options).load(path)


def _run(stream: DataFrame, each, checkpoint: str, mode: str, trigger: dict) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).outputMode(mode)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def ingest_stream(
    articles: DataFrame,
    table_path: str,
    checkpoint: str,
    lateness: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the valid, first-seen articles of a stream to the article table.

    ``articles`` is a stream of combined article rows with ``position``. Repeats inside a
    micro-batch and repeats of stored rows are both removed in the batch itself, without
    stream state. ``lateness`` adds a watermark that drops repeats within it beforehand,
    worth its state only when most rows are repeats.
    """
    checked = feed.with_reject_reason(articles).where(F.col("reject_reason").isNull())
    if lateness is not None:
        checked = checked.withWatermark("published_at", lateness).dropDuplicatesWithinWatermark(
            ["naver_url"]
        )

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = materialise(batch.drop("reject_reason"), f"stream-ingest-{batch_id}")
        first = dedup.first_per_key(rows, ["naver_url"], "position")
        stored = tables.read_table(batch.sparkSession, table_path)
        tables.append_articles(
            materialise(dedup.drop_stored(first, stored).drop("position"), f"stream-new-{batch_id}"),
            table_path,
        )

    return _run(checked, append, checkpoint, "append", trigger or {"availableNow": True})


#: Keys of rows a feed stream has kept, with the time the rows were published.
KEPT_KEYS = StructType([
    StructField("url", StringType()), StructField("digest", StringType()), StructField("published_at", TimestampType()),
])


def feed_stream(
    items: DataFrame,
    articles_path: str,
    journalists_path: str,
    checkpoint: str,
    scope: Sequence[str] = ("keyword",),
    lateness: str | None = None,
    asof: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The ingest job on a feed that arrives piece by piece: the twin of ``jobs.ingest``.

    ``items`` is a stream of combined article rows with ``position`` and the columns of
    ``scope``, in feed order from file to file. What a micro-batch keeps is remembered by its
    keys next to the checkpoint: a later row of its scope with the same URL or content is dropped,
    as if the whole feed had come at once. Journalists are found or created, then articles
    appended. ``lateness`` (as "30 days") lets go of keys published that long before the newest
    one; a copy that comes later still is only known by its stored URL. Null keeps all keys.

    The tables must exist. A replayed micro-batch sees the keys from before it and finds what
    it had written stored already.
    """
    spark = items.sparkSession
    checked = feed.with_reject_reason(items)
    held = HeldRows(spark, f"{checkpoint}/held", KEPT_KEYS)

    def recent(keys: DataFrame) -> DataFrame:
        if lateness is None:
            return keys
        newest = keys.agg(F.max("published_at")).first()[0]
        return keys.where(F.col("published_at") >= F.lit(newest) - F.expr(f"interval {lateness}"))

    def ingest(batch: DataFrame, batch_id: int) -> None:
        held.compact(batch_id, recent)
        rows = materialise(batch, f"stream-feed-{batch_id}")
        valid = rows.where(F.col("reject_reason").isNull()).drop("reject_reason")
        earlier = held.read(batch_id)
        unique = materialise(dedup.feed_dedup(valid, scope=scope, earlier=earlier), f"stream-unique-{batch_id}")
        stored, people = tables.read_table(spark, articles_path), tables.read_journalists(spark, journalists_path)
        result = jobs.admit(valid, unique, stored, people, rows.where(F.col("reject_reason").isNotNull()))
        jobs.save_ingest(result, articles_path, journalists_path, asof)
        keys = dedup.feed_keys(unique, scope=scope).withColumnRenamed("pos", "position")
        held.write(unique.select("position", "published_at").join(keys, "position"), batch_id)

    return _run(checked, ingest, checkpoint, "append", trigger or {"availableNow": True})


def score_stream(
    lines: DataFrame,
    table_path: str,
    batches: DataFrame,
    checkpoint: str,
    asof: Column,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply result lines (``batch_id``, ``pos``, ``value``) to the article table as they land.

    A batch must arrive in one micro-batch for its strict check, as result files do.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = materialise(batch, f"stream-results-{batch_id}")
        stored = tables.read_table(batch.sparkSession, table_path)
        jobs.save_scores(table_path, jobs.read_results(rows, stored, batches).updates, asof)

    return _run(lines, apply, checkpoint, "append", trigger or {"availableNow": True})


#: Result lines that wait for the rest of their batch, and batches that need to wait no longer.
WAITING_LINES = StructType([
    StructField("batch_id", StringType()), StructField("pos", LongType()), StructField("value", StringType()),
    StructField("arrived_at", TimestampType()),
])
SETTLED = StructType([StructField("batch_id", StringType())])


def short_batches(waiting: DataFrame, batches: DataFrame, asof: Column, patience: str) -> DataFrame:
    """``batch_id, expected, n_lines, first_at``: incomplete batches whose first line came longer
    than ``patience`` before ``asof``."""
    counts = waiting.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_lines"), F.min("arrived_at").alias("first_at"))
    known = batches.groupBy("batch_id").agg(F.max("article_count").alias("expected"))
    old = F.col("first_at") < asof.cast("timestamp") - F.expr(f"interval {patience}")
    missing = F.col("expected").isNull() | (F.col("n_lines") < F.col("expected"))
    return counts.join(known, "batch_id", "left").where(old & missing).select("batch_id", "expected", "n_lines", "first_at")


def complete_score_stream(
    lines: DataFrame,
    table_path: str,
    batches: DataFrame,
    checkpoint: str,
    asof: Column,
    patience: str = "24 hours",
    trigger: dict | None = None,
) -> StreamingQuery:
    """``score_stream`` for batches that arrive piece by piece: applied when whole, or not at all.

    ``lines`` has ``batch_id``, ``pos`` and ``value``; blank lines do not count. Lines wait next
    to the checkpoint until as many are there as ``article_count`` of ``batches`` says; then the whole
    batch goes through the strict check, so that one bad line, wherever it came, keeps all of it
    back. A line that comes again with the same ``pos`` counts once, the latest holds. Batches
    that ``batches`` does not know wait. Lines of settled batches are ignored.

    ``waiting_batches`` reads what is still held; a batch that stays short longer than
    ``patience`` is written to ``short`` in the same folder by each micro-batch that finds it so.
    Only counts are gathered per batch: lines stay spread over the cluster.
    """
    spark = lines.sparkSession
    held_path = f"{checkpoint}/held"
    waiting = HeldRows(spark, f"{held_path}/lines", WAITING_LINES)
    settled = HeldRows(spark, f"{held_path}/settled", SETTLED)
    expected = batches.groupBy("batch_id").agg(F.max("article_count").alias("expected"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        done = settled.read(batch_id).distinct()
        waiting.compact(batch_id, lambda rows: _open_lines(rows, done))
        settled.compact(batch_id, lambda rows: rows.distinct())
        found = batch.where(strip(F.col("value")) != "").withColumn("arrived_at", asof.cast("timestamp"))
        waiting.write(found.withColumn("pos", F.col("pos").cast("long")), batch_id)
        held = materialise(_open_lines(waiting.read(batch_id + 1), settled.read(batch_id)), f"stream-held-{batch_id}")
        counts = held.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_lines"))
        whole = counts.join(expected, "batch_id").where("n_lines >= expected").select("batch_id")
        whole = materialise(whole, f"stream-whole-{batch_id}")
        if not whole.isEmpty():
            rows = skew.salted_join(held, whole, ["batch_id"], "left_semi", spread=["pos"])
            rows = materialise(rows.drop("arrived_at"), f"stream-results-{batch_id}")
            stored = tables.read_table(spark, table_path)
            jobs.save_scores(table_path, jobs.read_results(rows, stored, batches).updates, asof)
        settled.write(whole, batch_id)
        rest = held.join(skew.broadcast_if_small(whole), "batch_id", "left_anti")
        short = short_batches(rest, batches, asof, patience)
        short.write.mode("overwrite").parquet(f"{held_path}/short")

    return _run(lines, apply, checkpoint, "append", trigger or {"availableNow": True})


def _open_lines(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """Lines of batches that are not settled, one per batch and position."""
    left = skew.salted_join(rows, settled.distinct(), ["batch_id"], "left_anti", spread=["pos"])
    newest = F.max(F.struct("arrived_at", "value")).alias("_line")
    first = F.min("arrived_at").alias("_first")
    one = left.groupBy("batch_id", "pos").agg(newest, first)
    return one.select("batch_id", "pos", F.col("_line.value").alias("value"), F.col("_first").alias("arrived_at"))


def waiting_batches(spark, checkpoint: str, batches: DataFrame) -> DataFrame:
    """``batch_id, expected, n_lines, first_at`` of every batch with lines that still wait."""
    end, held_path = 1 << 62, f"{checkpoint}/held"
    rows = HeldRows(spark, f"{held_path}/lines", WAITING_LINES).read(end)
    done = HeldRows(spark, f"{held_path}/settled", SETTLED).read(end)
    return short_batches(_open_lines(rows, done), batches, F.to_timestamp(F.lit("9999-12-31")), "0 days")


def daily_trend(scores: DataFrame, offset_hours: int = S.LOCAL_OFFSET_HOURS) -> DataFrame:
    """Rows, scored rows and score sum per local day; works on batch and stream frames.

    Windows start at local midnight: 24 hours less the zone offset in UTC.
    """
    day = F.window("ts", "1 day", "1 day", f"{24 - offset_hours} hours")
    return scores.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("score").alias("n_scored"),
        F.sum("score").alias("score_sum"),
        F.max("score").alias("max_score"),
    )


def trend_columns(trend: DataFrame, offset_hours: int = S.LOCAL_OFFSET_HOURS) -> DataFrame:
    """Local date and mean score in place of the window and the sum."""
    local = F.col("day.start") + F.make_dt_interval(hours=F.lit(offset_hours))
    return trend.select(
        F.date_format(local, "yyyy-MM-dd").alias("day"),
        "n_rows",
        "n_scored",
        (F.col("score_sum") / F.col("n_scored")).alias("mean_score"),
        "max_score",
    )


def trend_stream(
    scores: DataFrame,
    out_path: str,
    checkpoint: str,
    lateness: str = "2 days",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the changed days of each micro-batch under its batch number; late rows are dropped.

    A replayed batch overwrites its own folder. ``latest_trend`` reads the current values.
    """
    watermarked = scores.withWatermark("ts", lateness)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return _run(
        daily_trend(watermarked), upsert, checkpoint, "update", trigger or {"availableNow": True}
    )


def latest_trend(spark, out_path: str) -> DataFrame:
    """The last written row of each day."""
    rows = spark.read.parquet(out_path)
    values = F.struct("n_rows", "n_scored", "score_sum", "max_score")
    return (
        rows.groupBy("day").agg(F.max_by(values, "batch").alias("v")).select("day", "v.*")
    )


