"""The journalist dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.functions.records import journalist_key
from presswork.functions.text import normalize_name, normalize_publisher
from presswork.operators import skew

NATURAL_KEY = ["name", "publisher"]


def normalized(articles: DataFrame) -> DataFrame:
    """Articles with reporter and publisher in their normal form."""
    return articles.withColumn("publisher", normalize_publisher(F.col("publisher"))).withColumn(
        "journalist_name", normalize_name(F.col("journalist_name"), F.col("publisher"))
    )


def distinct_journalists(articles: DataFrame) -> DataFrame:
    """Distinct (name, publisher) of the articles, normalised."""
    return (
        normalized(articles.select("journalist_name", "publisher"))
        .select(F.col("journalist_name").alias("name"), "publisher")
        .distinct()
    )


def new_journalists(articles: DataFrame, journalists: DataFrame) -> DataFrame:
    """Journalists to append: not stored yet, with empty statistics and a key-derived id."""
    missing = distinct_journalists(articles).join(
        journalists.select(*NATURAL_KEY), NATURAL_KEY, "left_anti"
    )
    return missing.select(
        journalist_key(F.col("name"), F.col("publisher")).alias("id"),
        "name",
        "publisher",
        F.lit(0).cast("long").alias("article_count"),
        F.lit(0.0).alias("avg_clickbait_score"),
        F.lit(0).alias("max_score"),
    )


def resolve(articles: DataFrame, journalists: DataFrame) -> DataFrame:
    """{name, publisher, id, is_new} for every journalist of the articles: found or created."""
    known = journalists.select(*NATURAL_KEY, F.col("id").alias("known_id"))
    return distinct_journalists(articles).join(known, NATURAL_KEY, "left").select(
        *NATURAL_KEY,
        F.coalesce("known_id", journalist_key(F.col("name"), F.col("publisher"))).alias("id"),
        F.col("known_id").isNull().alias("is_new"),
    )


def attach_ids(
    articles: DataFrame, resolved: DataFrame, hot_rows: int = skew.HOT_ROWS
) -> DataFrame:
    """Add ``journalist_id``; null where the dimension has no such journalist.

    Reporters without a name share one key per publisher, so hot keys are salted.
    """
    keyed = normalized(articles.drop("journalist_id"))
    ids = resolved.select(
        F.col("name").alias("journalist_name"), "publisher", F.col("id").alias("journalist_id")
    )
    return skew.salted_join(
        keyed, ids, ["journalist_name", "publisher"], "left", spread=["id"], hot_rows=hot_rows
    )
