"""Stored URLs beside the article table, laid out by a hash of the URL.

An ingest asks whether some URLs are stored. From the article table it would read every URL
ever stored; here it reads the buckets of the URLs it asks for.

The side table must not lack a stored URL. ``announce`` notes the URLs of a run before its
articles are appended, ``settle`` adds them afterwards. Of a run that stopped in between,
``recover`` adds those that reached the article table. One ingest at a time writes to a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import settings as S
from presswork.sources import folders
from presswork.sources.tables import read_table
from presswork.operators import skew
from presswork.schemas import STORED_URL


def bucket_of(url: Column, buckets: int = S.URL_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def append(urls: DataFrame, path: str, buckets: int = S.URL_BUCKETS) -> None:
    """Add URLs (column ``naver_url``); null ones are left out. One may be added again, to no effect."""
    rows = urls.select("naver_url").where(F.col("naver_url").isNotNull())
    rows = rows.withColumn("bucket", bucket_of(F.col("naver_url"), buckets)).hint("rebalance", F.col("bucket"))
    rows.write.mode("append").partitionBy("bucket").parquet(path)


def among(urls: DataFrame, path: str, buckets: int = S.URL_BUCKETS) -> DataFrame:
    """Stored URLs of the buckets that ``urls`` (column ``naver_url``) fall into, to look these up in.

    The list of buckets is at most ``buckets`` numbers long, and part of the plan: other
    buckets' files are not opened. A table that is not there yet holds nothing.
    """
    spark = urls.sparkSession
    if not folders.exists(spark, path):
        return spark.createDataFrame([], STORED_URL).select("naver_url")
    asked = urls.where(F.col("naver_url").isNotNull()).select(bucket_of(F.col("naver_url"), buckets).alias("bucket"))
    numbers = sorted(row.bucket for row in asked.distinct().collect())
    stored = read_table(spark, path, STORED_URL)
    held = stored if len(numbers) == buckets else stored.where(F.col("bucket").isin(numbers))
    return held.select("naver_url")


def _announced(path: str) -> str:
    return f"{path.rstrip('/')}_announced"


def announce(urls: DataFrame, path: str) -> str:
    """Note the URLs of articles about to be appended; the name to ``settle`` them by."""
    name = uuid.uuid4().hex
    urls.select("naver_url").write.parquet(f"{_announced(path)}/{name}")
    return name


def settle(spark: SparkSession, name: str, path: str, buckets: int = S.URL_BUCKETS) -> None:
    """Add the announced URLs, whose articles are stored now."""
    noted = f"{_announced(path)}/{name}"
    append(read_table(spark, noted, STORED_URL), path, buckets)
    folders.remove(spark, noted)


def recover(spark: SparkSession, path: str, articles_path: str, buckets: int = S.URL_BUCKETS) -> int:
    """Complete what runs that stopped left announced; how many runs there were.

    Part of their articles may have been stored, so the article table decides.
    """
    names = folders.children(spark, _announced(path))
    for name in names:
        noted = f"{_announced(path)}/{name}"
        if folders.exists(spark, articles_path):
            wanted = skew.broadcast_if_small(read_table(spark, noted, STORED_URL).select("naver_url"))
            articles = read_table(spark, articles_path).select("naver_url")
            append(articles.join(wanted, "naver_url", "left_semi").distinct(), path, buckets)
        folders.remove(spark, noted)
    spark.catalog.refreshByPath(path)
    return len(names)
