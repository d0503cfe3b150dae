"""Connected components, and links inside buckets of candidates, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import discard, store


def _toward(edges: DataFrame, round: int) -> DataFrame:
    """(u, to): the member of u's closed neighbourhood that comes first in this round's order.

    A fresh pseudo-random order per round lets long chains shrink by a constant factor.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    rank = lambda c: F.struct(F.xxhash64(F.lit(round), c).alias("h"), F.col(c).alias("id"))
    best = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
    return best.select(F.col("a").alias("u"), F.least(F.col("near"), rank("a"))["id"].alias("to"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, root): every id that occurs in an edge and the least id of its component.

    Each round maps every vertex to one vertex of its neighbourhood and keeps the edges
    between different images, until none is left.  Edges may repeat; loops and edges with
    a null end are ignored.  Nothing but the number of edges left reaches the driver.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a") != F.col("b"))
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = store(links, "links")
    labels, round = None, 0
    while not links.isEmpty():
        step = store(_toward(links, round), "contraction")
        ends = links.join(step.withColumnRenamed("u", "a"), "a").select(F.col("to").alias("x"), "b")
        ends = ends.join(step.withColumnRenamed("u", "b"), "b").select("x", F.col("to").alias("y")).filter(F.col("x") != F.col("y"))
        shrunk = store(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if labels is None:
            moved = step.select(F.col("u").alias("id"), F.col("to").alias("label"))
        else:
            moved = labels.join(step.withColumnRenamed("u", "label"), "label", "left").select(
                "id", F.coalesce("to", "label").alias("label")
            )
        former = [links, step] + ([labels] if labels is not None else [])
        labels = store(moved, "labels")
        discard(*former)
        links, round = shrunk, round + 1
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    least = labels.groupBy("label").agg(F.min("id").alias("root"))
    return labels.join(least, "label").select("id", "root")


def bucket_links(
    rows: DataFrame,
    bucket: list[str],
    id: str,
    close: Callable[[str, str], Column],
    verify: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
    rank: str | None = None,
    between: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(a, b): links that connect all ids which some chain of verified pairs connects.

    A pair counts when both ids share a bucket, ``close`` holds for their rows (it gets the
    prefixes of both rows' columns) and ``verify`` lets the pair through.  Not all pairs
    of a bucket are written out: first every row is paired with the first of its bucket
    (by ``rank``, then ``id``; best is one that is likely to be linked to most others);
    buckets that those links make one component hold nothing more to find, and of the
    others only pairs between different components are tested: by ``between``, which gets
    the rows of those buckets with their ``root`` and returns (a, b), or else inside a join.
    ``rows`` has one row per bucket and id and is computed twice; ids alone in their bucket
    go first.
    """
    first = [F.col(rank)] if rank else []
    others = [F.col(c) for c in rows.columns if c not in (*bucket, id, rank)]
    row = lambda p: F.struct(*first, F.col(id).alias("id"), *others).alias(p)
    # a plain minimum is aggregated by hashing, that of a struct by sorting
    head = F.min(row("_")) if first or others else F.struct(F.min(id).alias("id"))
    several = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*bucket)
    shared = store(rows.join(several.hint("shuffle_hash"), bucket, "left_semi"), "shared-buckets", sweep=True)
    heads = shared.groupBy(*bucket).agg(head.alias("a"))
    paired = shared.select(*bucket, row("b")).join(heads, bucket)
    near = paired.filter((F.col("a.id") != F.col("b.id")) & close("a.", "b."))
    star = store(verify(near.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()), "star-links", sweep=True)
    roots = store(components(star, "a", "b"), "star-roots")
    tagged = shared.join(roots.withColumnRenamed("id", id), id, "left").withColumn("root", F.coalesce("root", F.col(id)))
    tagged = store(tagged, "tagged-buckets")
    mixed = tagged.groupBy(*bucket).agg(F.min("root").alias("_x"), F.max("root").alias("_y")).filter("_x < _y").select(*bucket)
    left = tagged.join(mixed, bucket, "left_semi")
    if between is not None:
        rest = store(between(store(left, "mixed-buckets", sweep=True)), "cross-links", sweep=True)
        return star.select("a", "b").union(rest.select("a", "b"))
    left = store(left.withColumn("_at", F.xxhash64(*bucket)), "mixed-buckets", sweep=True)
    shared_by = left.groupBy(id).agg(F.collect_set("_at").alias("_all"))
    left = left.join(shared_by, id)
    own = [*bucket, "root", "_at", "_all"]
    side = lambda p: left.select(*[F.col(c).alias(f"{p}_{c}") for c in own], row(p))
    same = F.lit(True)
    for c in bucket:
        same = same & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    # a pair comes out of the first bucket that both are in, not of all
    once = F.array_min(F.array_intersect("a__all", "b__all")) == F.col("a__at")
    cross = side("a").join(side("b"), same & (F.col("a_root") < F.col("b_root")) & close("a.", "b.") & once)
    ordered = cross.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()
    rest = store(verify(ordered), "cross-links", sweep=True)
    return star.select("a", "b").union(rest.select("a", "b"))
