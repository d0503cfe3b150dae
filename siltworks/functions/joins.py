"""Joining against a side whose size is checked first, or whose keys are very uneven."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.scratch import materialize

BROADCAST_ROWS = 200_000
#: a key is hot from one row in so many
SHARE = 1000


def join_small(big: DataFrame, small: DataFrame, on: str | list[str] | Column, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with ``small``, broadcast only after its rows have been counted.

    ``small`` must be narrow.  It is written once to shared storage, so the count and
    the join read the same rows and the plan that made it does not run twice.  Past the
    limit the join is an ordinary shuffled one.
    """
    stored = materialize(small, "small-side")
    return big.join(F.broadcast(stored) if stored.count() <= limit else stored, on, how)


def hot_keys(rows: DataFrame, on: list[str], share: int = SHARE) -> DataFrame:
    """The keys that hold at least one row in ``share``: at most ``share`` keys, stored.

    One count per key, combined before the shuffle; null keys are left out.
    """
    counts = materialize(rows.dropna(subset=on).groupBy(*on).count(), "key-counts")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    return materialize(counts.filter((F.col("count") > 1) & (F.col("count") * share >= total)).select(*on), "hot-keys")


def join_spread(rows: DataFrame, keyed: DataFrame, on: list[str], how: str = "left", share: int = SHARE) -> DataFrame:
    """Join (``left`` or ``inner``) with ``keyed``, one row per key, whatever share of ``rows`` a key holds.

    Rows of hot keys stay where they are and meet a broadcast of at most ``share`` rows of
    ``keyed``, as do rows with a null key, which match nothing.  The others are shuffled,
    and none of their keys holds more than one row in ``share``.  ``rows`` is read three
    times and should be a stored or cheaply scanned table; ``keyed`` is read twice.
    """
    hot = hot_keys(rows, on, share)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), on, "left")
    still = reduce(Column.__or__, [F.col(c).isNull() for c in on], F.coalesce("_hot", F.lit(False)))
    near = marked.filter(still).drop("_hot").join(F.broadcast(keyed.join(F.broadcast(hot), on, "left_semi")), on, how)
    far = marked.filter(~still).drop("_hot").join(keyed, on, how)
    return near.unionByName(far)
