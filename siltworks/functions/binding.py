"""Values that an expression needs more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once.

    A column that is only used inside a lambda is moved into it by the optimizer and computed
    again for every element; a bound value is not.
    """
    return F.transform(F.array(value), body)[0]


def shares(weights: Column) -> Column:
    """An array of numbers divided by their sum."""
    return let(weights, lambda ws: let(F.aggregate(ws, F.lit(0.0), lambda a, w: a + w), lambda total: F.transform(ws, lambda w: w / total)))
