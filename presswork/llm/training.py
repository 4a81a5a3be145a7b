"""Bounded samples of labelled rows, and models fitted on them in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import bounded_batches, held_out, small

_DRAWS = 1 << 30


def training_rows(
    docs: DataFrame, labels: DataFrame, rows_per_label: int, seed: int, id_col: str, text_col: str
) -> DataFrame:
    """``draw, text, label`` of about ``rows_per_label`` rows of each label, picked by a hash of the id.

    Rows whose crc32 of the id divides by five are never among them; nor are rows without id,
    text or label. ``labels`` has the columns ``id`` and ``label``, one row per id.
    """
    known = labels.where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    known = known.withColumn("draw", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(_DRAWS)))
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    share = counts.select("label", (F.lit(float(rows_per_label) * _DRAWS) / F.col("n")).alias("most"))
    picked = known.join(small(share), "label").where("draw < most")
    picked = picked.select("id", "label", "draw")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.where("text IS NOT NULL").join(small(picked), "id").select("draw", "text", "label")


def fit_in_task(sample: DataFrame, fit: Callable[[Iterator[pd.DataFrame]], bytes]) -> bytes:
    """Run ``fit`` over the sample in one task; only the model comes to the driver.

    Rows come in the order of their draw, so that a rerun gives the same model. An empty
    sample reaches ``fit`` as no batches.
    """
    spark = sample.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"model": [fit(batches)]})

    ordered = sample.repartition(1).sortWithinPartitions("draw", "text")
    found = ordered.mapInPandas(run, "model binary").collect()
    return bytes(found[0].model) if found else fit(iter(()))
