"""Journalist and publisher statistics, their audit and their repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork import settings as S

COUNTERS = [
    "total_journalists", "active_journalists", "scored_journalists",
    "total_articles", "scored_articles", "pending_articles",
]

#: What a journalist row stores of its statistics.
STORED = ["article_count", "avg_clickbait_score", "max_score"]


def score_statistics(
    articles: DataFrame,
    keys: Sequence[str] = ("journalist_id",),
    score: str = "clickbait_score",
    top: int = S.TOP_SCORES,
) -> DataFrame:
    """Per key: article count, mean of the ``top`` highest scores, full mean and maximum.

    Scores are integers in a small range, so rows are first counted per (key, score). That
    step combines on the map side and leaves about a hundred rows for the largest key; the
    top scores are then read off the counts, best first.
    """
    counts = articles.groupBy(*keys, F.col(score).alias("_score")).agg(F.count(F.lit(1)).alias("_n"))
    better = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_score").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    room = F.lit(top) - F.coalesce(F.sum("_n").over(better), F.lit(0))
    taken = F.when(F.col("_score").isNotNull(), F.least("_n", F.greatest(room, F.lit(0)))).otherwise(0)
    scored = F.when(F.col("_score").isNotNull(), F.col("_n")).otherwise(0)
    summed = (
        counts.withColumn("_taken", taken)
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("article_count"),
            F.sum(scored).alias("scored_count"),
            F.sum(F.col("_taken") * F.col("_score")).alias("_top_sum"),
            F.sum("_taken").alias("_top_n"),
            F.sum(F.col("_n") * F.col("_score")).alias("_sum"),
            F.max("_score").alias("_max"),
        )
    )
    some = F.col("scored_count") > 0
    return summed.select(
        *keys,
        "article_count",
        "scored_count",
        F.when(some, F.bround(F.col("_top_sum") / F.col("_top_n"), 2))
        .otherwise(0.0)
        .alias("avg_clickbait_score"),
        F.when(some, F.col("_sum") / F.col("scored_count")).otherwise(0.0).alias("mean_score"),
        F.coalesce("_max", F.lit(0)).alias("max_score"),
    )


def journalist_statistics(articles: DataFrame) -> DataFrame:
    """Statistics as they are stored per journalist."""
    return score_statistics(articles).select(
        "journalist_id", "article_count", "avg_clickbait_score", "max_score"
    )


def all_journalist_statistics(journalists: DataFrame, articles: DataFrame) -> DataFrame:
    """Every journalist with fresh statistics; ``updated`` is false where there is no article."""
    fresh = journalist_statistics(articles).withColumnRenamed("journalist_id", "id")
    renamed = fresh.select(
        "id",
        F.col("article_count").alias("_count"),
        F.col("avg_clickbait_score").alias("_avg"),
        F.col("max_score").alias("_max"),
    )
    return _take_over(journalists.join(renamed, "id", "left"), F.col("_count").isNotNull())


def _take_over(joined: DataFrame, condition) -> DataFrame:
    """Replace the stored statistics by ``_count``, ``_avg``, ``_max`` where ``condition`` holds."""
    result = joined.withColumn("updated", condition)
    for stored, fresh in (
        ("article_count", "_count"), ("avg_clickbait_score", "_avg"), ("max_score", "_max"),
    ):
        kind = joined.schema[stored].dataType
        value = F.when(F.col("updated"), F.col(fresh).cast(kind)).otherwise(F.col(stored))
        result = result.withColumn(stored, value)
    return result.drop("_count", "_avg", "_max")


def update_totals(updated: DataFrame) -> DataFrame:
    """{success, failed, total} of ``all_journalist_statistics``."""
    return updated.agg(
        F.count_if("updated").alias("success"),
        F.count_if(~F.col("updated")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def audit(journalists: DataFrame, articles: DataFrame, mode: str = "full_mean") -> DataFrame:
    """Stored next to actual values, with ``inconsistent``.

    ``full_mean`` compares the stored average, a mean of the top scores, with the mean of all
    scores: anyone with more than ten scored articles is likely to stay flagged. ``top10``
    compares it with the value a repair stores.
    """
    column = {"full_mean": "mean_score", "top10": "avg_clickbait_score"}[mode]
    actual = score_statistics(articles).select(
        F.col("journalist_id").alias("id"),
        F.col("article_count").alias("actual_count"),
        F.col(column).alias("actual_avg"),
        F.col("max_score").alias("actual_max"),
        F.col("avg_clickbait_score").alias("top_avg"),
    )
    joined = journalists.join(actual, "id", "left").select(
        *journalists.columns,
        F.coalesce("actual_count", F.lit(0)).alias("actual_count"),
        F.coalesce("actual_avg", F.lit(0.0)).alias("actual_avg"),
        F.coalesce("actual_max", F.lit(0)).alias("actual_max"),
        "top_avg",
    )
    # A value that was never stored counts as zero.
    stored_avg = F.coalesce("avg_clickbait_score", F.lit(0.0))
    differs = (
        (F.coalesce("article_count", F.lit(0)) != F.col("actual_count"))
        | (F.abs(stored_avg - F.col("actual_avg")) > S.STORED_AVG_TOLERANCE)
        | (F.coalesce("max_score", F.lit(0)) != F.col("actual_max"))
    )
    return joined.withColumn("inconsistent", differs)


def repair(audited: DataFrame) -> DataFrame:
    """Audited journalists with fresh statistics where flagged; ``updated`` tells which.

    A flagged journalist without articles cannot be repaired and keeps its stored values.
    """
    ready = (
        audited.withColumn("_count", F.col("actual_count"))
        .withColumn("_avg", F.col("top_avg"))
        .withColumn("_max", F.col("actual_max"))
    )
    return _take_over(ready, F.col("inconsistent") & (F.col("actual_count") > 0)).drop(
        "actual_count", "actual_avg", "actual_max", "top_avg"
    )


def repair_totals(repaired: DataFrame) -> DataFrame:
    """{fixed, total_inconsistent, total_checked}."""
    return repaired.agg(
        F.count_if("updated").alias("fixed"),
        F.count_if("inconsistent").alias("total_inconsistent"),
        F.count(F.lit(1)).alias("total_checked"),
    )


def summary(journalists: DataFrame, articles: DataFrame) -> DataFrame:
    """One row with the six counters; the two one-row aggregates are merged by a union."""
    people = journalists.agg(
        F.count(F.lit(1)).alias("total_journalists"),
        F.count_if(F.col("article_count") > 0).alias("active_journalists"),
        F.count_if(F.col("avg_clickbait_score") > 0).alias("scored_journalists"),
    )
    texts = articles.agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.count("clickbait_score").alias("scored_articles"),
        F.count_if(F.col("clickbait_score").isNull()).alias("pending_articles"),
    )
    both = people.unionByName(texts, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in COUNTERS])


def deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counter, value before, value after and change."""

    def long(frame: DataFrame, value: str) -> DataFrame:
        return frame.unpivot([], COUNTERS, "counter", value)

    return long(before, "before").join(long(after, "after"), "counter").withColumn(
        "change", F.col("after") - F.col("before")
    )


def publisher_statistics(articles: DataFrame) -> DataFrame:
    """Article count, scored count, mean and maximum score per publisher."""
    return articles.groupBy("publisher").agg(
        F.count(F.lit(1)).alias("article_count"),
        F.count("clickbait_score").alias("scored_count"),
        F.bround(F.avg("clickbait_score"), 2).alias("mean_score"),
        F.max("clickbait_score").alias("max_score"),
    )
