"""Request and result files: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import schemas
from presswork.functions.once import computed_once
from presswork.functions.text import strip
from presswork.functions.validation import parse_json_strict


def write_requests(requests: DataFrame, path: str, batch_column: str | None = "batch_no") -> None:
    """Write the ``request`` struct as JSON lines, one folder per batch.

    Batches hold a bounded number of requests, so one task per batch is a small file.
    """
    lines = F.to_json("request").alias("value")
    if batch_column is None:
        requests.select(lines).write.text(path)
        return
    requests.repartition(batch_column).select(batch_column, lines).write.partitionBy(
        batch_column
    ).text(path)


def read_result_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with their batch (folder ``batch_id=...``) and their place in the input.

    ``pos`` orders lines as they stand in the files: a file may be read in several blocks,
    and the line number grows within a block.
    """
    text = spark.read.option("basePath", path).text(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return text.select("*", place.alias("pos"))


def parse_result_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Drop blank lines, flag malformed ones and parse the others.

    ``malformed`` rows keep a null ``result`` so that callers can count them before
    filtering; well-formed JSON that is not a result object parses to nulls.
    """
    body = F.col(column)
    kept = lines.where(strip(body) != "")
    malformed = parse_json_strict(body).isNull()
    return kept.select(
        *[c for c in lines.columns if c != column],
        computed_once(
            malformed.alias("malformed"),
            F.when(~malformed, F.from_json(body, schemas.RESULT_LINE)).alias("result"),
        ),
    )
