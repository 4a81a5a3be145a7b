"""Parquet tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presswork import schemas
from presswork import settings as S
from presswork.functions.dates import local_date


#: Spark lists many folders with a task each, up to this many tasks; by default with 10,000.
LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 64


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Lower the number of listing tasks while a table is opened: a task costs more than its folder."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    with _few_listing_tasks(spark):
        return reader.parquet(path)


def with_local_date(articles: DataFrame) -> DataFrame:
    """Add the partition column of the article table."""
    return articles.withColumn("local_date", local_date(F.col("published_at")))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; what ``df`` lacks is null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def _by_day(articles: DataFrame) -> DataFrame:
    """One writer per day, several for a day that is large: AQE splits and merges by size."""
    return articles.hint("rebalance", F.col("local_date"))


def append_articles(articles: DataFrame, path: str) -> None:
    """Append to the article table, laid out by local date."""
    _by_day(with_local_date(articles)).write.mode("append").partitionBy("local_date").parquet(path)


def replace_days(staged: DataFrame, path: str) -> None:
    """Overwrite only the days present in ``staged``, which must not be read from ``path``."""
    (
        _by_day(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("local_date")
        .parquet(path)
    )


def with_bucket(journalists: DataFrame, buckets: int = S.JOURNALIST_BUCKETS) -> DataFrame:
    """Add the partition column of the journalist table, a hash of the id."""
    return journalists.withColumn("bucket", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(buckets)).cast("int"))


def append_journalists(journalists: DataFrame, path: str, buckets: int = S.JOURNALIST_BUCKETS) -> None:
    """Append to the journalist table, laid out by a hash of the id."""
    rows = with_bucket(journalists, buckets).hint("rebalance", F.col("bucket"))
    rows.write.mode("append").partitionBy("bucket").parquet(path)


def read_journalists(spark: SparkSession, path: str) -> DataFrame:
    """The journalist table without its partition column."""
    return read_table(spark, path, schemas.JOURNALIST_TABLE).drop("bucket")
