"""Rows that a stream keeps between its micro-batches, as Parquet files.

Each micro-batch writes what it adds under its own number, so a replay overwrites its own part
and never reads it. Every so many parts the rows of all earlier micro-batches are written as one
full part in their place, so that the number of folders stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from presswork.sources import folders

PARTS = 16


class HeldRows:
    """Rows under ``path``. ``parts`` micro-batches are kept apart before they are made one."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, parts: int = PARTS):
        self.spark, self.path, self.schema, self.parts = spark, path, schema, parts

    def _numbers(self, kind: str, before: int) -> list[int]:
        """Micro-batches before ``before`` with a finished folder of this kind."""
        names = [n for n in folders.children(self.spark, self.path) if n.startswith(f"{kind}-")]
        found = sorted(int(n.split("-")[1]) for n in names)
        return [n for n in found if n < before and folders.exists(self.spark, f"{self.path}/{kind}-{n}/_SUCCESS")]

    def read(self, before: int) -> DataFrame:
        """All rows of micro-batches before ``before``."""
        full = self._numbers("full", before)[-1:]
        parts = [n for n in self._numbers("part", before) if not full or n > full[0]]
        paths = [f"{self.path}/full-{n}" for n in full] + [f"{self.path}/part-{n}" for n in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The rows that micro-batch ``batch_id`` adds, in place of those of an earlier try."""
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/part-{batch_id}")

    def compact(self, batch_id: int, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> bool:
        """Before ``batch_id`` adds its rows: make one of all parts before it, if there are enough.

        ``keep`` picks the rows that are still needed. Earlier micro-batches are never replayed
        once this one runs, so their folders go when the new one is complete.
        """
        if len(self._numbers("part", batch_id)) < self.parts:
            return False
        last = batch_id - 1
        keep(self.read(batch_id)).write.mode("overwrite").parquet(f"{self.path}/full-{last}")
        for name in folders.children(self.spark, self.path):
            if int(name.split("-")[1]) <= last and name != f"full-{last}":
                folders.remove(self.spark, f"{self.path}/{name}")
        return True
