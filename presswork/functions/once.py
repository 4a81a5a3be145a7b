"""Evaluate a costly expression once although several others use it.

Column expressions are trees: an expression that is used twice is in the plan twice, and
inside a lambda nothing removes the repetition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated a single time per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed_once(*columns: Column) -> Column:
    """Generator that yields ``columns`` as they are.

    Filters and projections above a generator refer to its output, so the optimizer does not
    copy the expressions into them.
    """
    return F.inline(F.array(F.struct(*columns)))
