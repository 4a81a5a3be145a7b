"""Connected components of rows that share keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.session import discard, materialise


def _hooks(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``part, target``: the smallest part that a part shares a key with, itself included."""
    lowest = None
    for key in keys:
        known = members.where(F.col(key).isNotNull())
        pairs = known.groupBy(key, "part").agg(F.lit(1).alias("one"))
        least = materialise(pairs.groupBy(key).agg(F.min("part").alias("target")), "key-parts")
        found = pairs.join(least, key).groupBy("part").agg(F.min("target").alias("target"))
        lowest = found if lowest is None else lowest.unionByName(found)
    return lowest.groupBy("part").agg(F.min("target").alias("target"))


def components(rows: DataFrame, row: str, keys: Sequence[str]) -> DataFrame:
    """``row, part``: rows that share the value of a key, directly or over others, share a part.

    ``row`` is unique; a part is called by its smallest row. A null key is shared with nobody.
    In each round every part hooks to the smallest part it shares a key with, and the hooks are
    followed to their ends by doubling. Only parts without a smaller neighbour are left, at most
    half of those that had any, so rounds and doublings grow with the logarithm of the rows.
    Each step is a written table.
    """
    members = materialise(rows.select(row, *keys, F.col(row).alias("part")), "parts")
    while True:
        hooks = materialise(_hooks(members, keys), "hooks")
        if hooks.where("target < part").isEmpty():
            discard(hooks)
            return members.select(row, "part")
        written = [hooks]
        while True:
            step = hooks.select(F.col("part").alias("target"), F.col("target").alias("next"))
            doubled = materialise(hooks.join(step, "target").select("part", "target", "next"), "hooks")
            written.append(doubled)
            hooks = doubled.select("part", F.col("next").alias("target"))
            if doubled.where("target <> next").isEmpty():
                break
        moved = members.join(hooks, "part", "left").select(
            row, *keys, F.coalesce("target", "part").alias("part")
        )
        moved = materialise(moved, "parts")
        discard(members, *written)
        members = moved
