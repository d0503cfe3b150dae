"""Exact global ranks in a reproducible pseudo-random order.

Rows are ordered by ``md5(id:salt)``.  A plain ``row_number`` over that order would
need one task; here the hash prefix spreads rows evenly over many buckets (whatever
the key distribution), only bucket *counts* are ranked globally, and rows are ranked
inside their own bucket.  ``digits`` hexadecimal digits make 16**digits buckets: the
default suits tables up to some 1e11 rows; the ranks do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.joins import join_small
from siltworks.functions.scratch import materialize


def shuffle_key(id: str, salt: int | str) -> Column:
    return F.md5(F.concat_ws(":", F.col(id).cast("string"), F.lit(str(salt))).cast("binary"))


def hash_rank(df: DataFrame, id: str = "id", salt: int | str = 42, by: tuple[str, ...] = (), digits: int = 4) -> DataFrame:
    """Add ``rank`` (1-based) within ``by`` in hash order; equals a plain row_number."""
    keyed = df.withColumn("_h", shuffle_key(id, salt)).withColumn("_b", F.substring("_h", 1, digits))
    counts = keyed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
        F.col("_b").alias("_ob"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    same = F.col("_b") == F.col("_ob")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy(*by, "_b").orderBy("_h", id)
    return (
        keyed.withColumn("_r", F.row_number().over(inside))
        .join(offsets, same)
        .select(*df.columns, (F.col("_r") + F.col("_offset")).cast("long").alias("rank"))
    )


def hash_cuts(df: DataFrame, wanted: DataFrame, by: str, id: str = "id", salt: int | str = 42, digits: int = 4) -> DataFrame:
    """The (hash, id) found at each wanted rank.

    ``wanted`` has (by, name, position).  Only the one bucket that holds a wanted rank
    is ever sorted, and only its ids.  Returns (by, name, cut) with cut = struct(h, id).
    """
    narrow = df.select(F.col(by).alias("_by"), F.col(id).alias("_id"), shuffle_key(id, salt).alias("_h")).withColumn(
        "_b", F.substring("_h", 1, digits)
    )
    counts = narrow.groupBy("_by", "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.partitionBy("_by").orderBy("_b").rowsBetween(W.unboundedPreceding, 0))
    spans = counts.select("_by", "_b", upto.alias("_hi"), (upto - F.col("_n")).alias("_lo"))
    targets = (
        spans.join(wanted.withColumnRenamed(by, "_by"), "_by")
        .filter((F.col("position") > F.col("_lo")) & (F.col("position") <= F.col("_hi")))
        .select("_by", "_b", "name", (F.col("position") - F.col("_lo")).alias("_k"))
    )
    order = W.partitionBy("_by", "_b").orderBy("_h", "_id")
    targets = materialize(targets, "targets")  # at most one row per wanted rank
    slices = join_small(narrow, targets.select("_by", "_b").distinct(), ["_by", "_b"], "left_semi")
    return (
        slices.withColumn("_r", F.row_number().over(order))
        .join(targets, ["_by", "_b"])
        .filter(F.col("_r") == F.col("_k"))
        .select(F.col("_by").alias(by), "name", F.struct(F.col("_h").alias("h"), F.col("_id").alias("id")).alias("cut"))
    )
