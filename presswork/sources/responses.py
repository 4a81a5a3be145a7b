"""Search and trend responses landed as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import schemas
from presswork import settings as S
from presswork.functions.text import allowed_keyword


def read_search_responses(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Response objects with an ``items`` array, one JSON object per line or file."""
    return spark.read.schema(schemas.SEARCH_RESPONSE).options(**options).json(path)


def parse_search_responses(df: DataFrame, column: str = "response") -> DataFrame:
    """Replace a JSON text column by its ``items`` array."""
    parsed = F.from_json(F.col(column), schemas.SEARCH_RESPONSE)
    return df.withColumn("items", parsed["items"]).drop(column)


def explode_items(df: DataFrame) -> DataFrame:
    """One row per item with its place in the response; a missing ``items`` gives no rows."""
    rest = [name for name in df.columns if name != "items"]
    return df.select(*rest, F.posexplode("items").alias("item_pos", "item")).select(
        *rest, "item_pos", "item.*"
    )


def read_trend_responses(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.read.schema(schemas.TREND_RESPONSE).options(**options).json(path)


def parse_trend_responses(df: DataFrame, column: str = "response") -> DataFrame:
    parsed = F.from_json(F.col(column), schemas.TREND_RESPONSE)
    return df.withColumn("trending_searches", parsed["trending_searches"]).drop(column)


def trend_keywords(df: DataFrame, limit: int = S.TREND_LIMIT) -> DataFrame:
    """First ``limit`` acceptable queries of each response, in response order.

    The choice is made inside the array of one response, so nothing is shuffled.
    """
    rest = [name for name in df.columns if name != "trending_searches"]
    queries = F.transform("trending_searches", lambda entry: entry.query)
    usable = F.filter(queries, lambda q: q.isNotNull() & allowed_keyword(q))
    return df.select(*rest, F.posexplode(F.slice(usable, 1, limit)).alias("rank", "keyword"))
