"""Replacing partitions of a Parquet table in two steps that can be taken up again.

``stage`` writes the new rows of some partitions next to the table, with a plan; ``finish``
puts the staged folders in place of the old ones. A run that stops in between, or in the
middle of the moves, is completed by the next ``finish`` from what is staged: nothing is
computed again and no row is lost. Other partitions are not touched.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presswork.sources import folders
from presswork.sources.tables import read_table

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
PLAN = "plan"


def folder_name(column: str, value: date | int | None) -> str:
    """Folder of a partition whose column is a date or a number."""
    return f"{column}={NO_VALUE if value is None else value}"


def among(column: str, values: Sequence[date | int | None]) -> Column:
    """Rows of these partitions, as one text: a list of many days would be built call by call."""
    known = [f"date'{value}'" if isinstance(value, date) else str(value) for value in values if value is not None]
    held = [f"{column} in ({', '.join(known)})"] if known else []
    return F.expr(" or ".join(held + [f"{column} is null"] * (None in values)) or "false")


def _changes(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_changes"


def stage(
    spark: SparkSession,
    table_path: str,
    column: str,
    values: Sequence[date | int | None],
    new_rows: Callable[[DataFrame], DataFrame],
    schema: StructType | None = None,
) -> None:
    """Write what ``new_rows`` makes of the partitions ``values``, and the plan to put it in place.

    The files of these partitions are listed before they are read; ``finish`` leaves a partition
    alone that has other files by then.
    """
    names = [folder_name(column, value) for value in values]
    held = folders.grandchildren(spark, table_path)
    files = {name: held.get(name, []) for name in names}
    part = read_table(spark, table_path, schema).where(among(column, values))
    run = f"{_changes(table_path)}/{uuid.uuid4().hex}"
    rows = new_rows(part).hint("rebalance", F.col(column))
    # Each task puts its own files there: nothing counts before the plan is written.
    rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(column).parquet(f"{run}/staged")
    folders.write_text(spark, f"{run}/{PLAN}", json.dumps(files))


def _put_in_place(
    spark: SparkSession, run: str, table_path: str, name: str, files: list[str], staged: list[str], moved: bool
) -> bool:
    """Move one partition. The old folder goes first, so its place tells how far an earlier run came."""
    place = f"{table_path}/{name}"
    if not moved:
        if folders.children(spark, place) != files:
            return False
        folders.move(spark, place, f"{run}/old/{name}")
    # File by file: rows appended since the old folder left keep their place.
    for file in staged:
        folders.move(spark, f"{run}/staged/{name}/{file}", f"{place}/{file}")
    return True


def finish(spark: SparkSession, table_path: str) -> list[str]:
    """Put everything staged in place; names of partitions that were appended to and so left alone.

    While a partition is moved, readers miss its rows for a moment.
    """
    left = []
    for name in folders.children(spark, _changes(table_path)):
        run = f"{_changes(table_path)}/{name}"
        if folders.exists(spark, f"{run}/{PLAN}"):
            plan = json.loads(folders.read_text(spark, f"{run}/{PLAN}"))
            staged, moved = folders.grandchildren(spark, f"{run}/staged"), set(folders.children(spark, f"{run}/old"))

            def placed(folder: str) -> bool:
                return _put_in_place(spark, run, table_path, folder, plan[folder], staged.get(folder, []), folder in moved)

            left += [folder for folder, done in zip(plan, folders.each(list(plan), placed)) if not done]
            # Without a plan the rest of the folder means nothing.
            folders.remove(spark, f"{run}/{PLAN}")
        folders.remove(spark, run)
    spark.catalog.refreshByPath(table_path)
    return left


def replace(
    spark: SparkSession,
    table_path: str,
    column: str,
    values: Sequence[date | int | None],
    new_rows: Callable[[DataFrame], DataFrame],
    schema: StructType | None = None,
    attempts: int = 5,
) -> None:
    """``stage`` and ``finish``, after what an earlier run left open; again where rows came in between."""
    finish(spark, table_path)
    for _ in range(attempts):
        if not values:
            return
        stage(spark, table_path, column, values, new_rows, schema)
        left = finish(spark, table_path)
        values = [value for value in values if folder_name(column, value) in left]
    if values:
        raise RuntimeError(f"{len(values)} partitions of {table_path} changed during each of {attempts} attempts")
