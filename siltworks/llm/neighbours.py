"""Nearest neighbours by inner product along shifted Hilbert curves.

Vectors are lifted by one coordinate so that the largest inner product becomes the nearest
point.  Each curve projects the points onto a few random directions, shifts them by a
random offset and orders them by their place on a Hilbert curve.  Spark range-partitions
every ordering; it is cut into blocks that also hold the last and first rows of the blocks
beside them, and every query is scored against its block.  The curves' results are merged
and the nearest kept.

How many curves are needed depends on the data: they are added ``BATCH`` at a time until
the recall on ``SAMPLE`` queries, searched by brute force, reaches ``RECALL``.  That sample
and ``FIT_ROWS`` rows for the scale of the projections are the only bounded parts; every
vector is on every curve.  Where the curves have shown a query as many rows as there are, and
``LEAST_CURVES`` at least, without reaching it, every query is searched exactly, ``ASKED`` at a time.

Equal vectors are one point with its smallest ids, so many copies do not fill a block.
Defined results: vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without an id or of another length than most vectors; ties go to the
smaller id; other columns do not matter; without vectors there are no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.tables import discard, quoted, running_offsets, store

DIRECTIONS, BITS = 4, 10
BLOCK, MARGIN = 8192, 4096
BATCH, LEAST_CURVES = 3, 60
#: queries that a pass of the exact search holds
ASKED = 5000
SAMPLE, RECALL = 200, 0.95
FIT_ROWS = 10_000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of every cell (rows of ``bits``-bit coordinates) on the Hilbert curve.

    The coordinates are turned into the curve's transposed Gray code bit by bit, from the
    coarsest cube to the finest, and their bits are interleaved.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            upper = (x[i] >> level) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> level) & 1 == 1, turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for column in x:
            key = (key << 1) | (((column ^ turn) >> level) & 1)
    return key


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _scores(query: np.ndarray, found: np.ndarray) -> np.ndarray:
    return (query * found).sum(axis=1)


def _nearest(queries: pd.DataFrame, others: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query, point, score) of the ``k`` best points for every query, by exact scores."""
    points, keys, least = _matrix(others["vector"]), others["point"].to_numpy(), others["least_id"].to_numpy()
    out = []
    for start in range(0, len(queries), 128):
        part = queries.iloc[start : start + 128]
        vectors = _matrix(part["vector"])
        rough = vectors @ points.T
        some = min(2 * k, len(points))
        best = np.argpartition(-rough, some - 1, axis=1)[:, :some]
        row, column = np.repeat(np.arange(len(part)), some), best.ravel()
        exact = _scores(vectors[row], points[column])
        order = np.lexsort((least[column], -exact, row))
        chosen = order.reshape(len(part), some)[:, :k].ravel()
        out.append(pd.DataFrame({"query": part["point"].to_numpy()[row[chosen]], "point": keys[column[chosen]], "score": exact[chosen]}))
    return pd.concat(out)


class _Curves:
    """Projections of lifted vectors onto the cells of shifted curves."""

    def __init__(self, first: int, width: int, norm: float, sample: np.ndarray):
        self.first, self.norm = first, norm
        lifted = self._lift(sample, np.zeros(len(sample), bool))
        self.maps = []
        for curve in range(first, first + BATCH):
            random = np.random.default_rng(curve)
            directions = np.linalg.qr(random.normal(size=(width + 1, min(DIRECTIONS, width + 1))))[0]
            seen = lifted @ directions
            self.maps.append((directions, seen.mean(0), seen.std(0) + 1e-12, random.uniform(0, 0.5, directions.shape[1])))

    def _lift(self, vectors: np.ndarray, asking: np.ndarray) -> np.ndarray:
        size = np.sqrt((vectors**2).sum(1))
        scaled = np.where(asking[:, None], vectors / size[:, None] * self.norm, vectors)
        extra = np.where(asking, 0.0, np.sqrt(np.maximum(self.norm**2 - size**2, 0)))
        return np.column_stack([scaled, extra])

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = _matrix(batch["vector"])
            for asking in (False, True):  # a query is a point of its own on the curve
                rows = batch["asks"].to_numpy(bool) if asking else np.ones(len(batch), bool)
                if not rows.any():
                    continue
                lifted = self._lift(vectors[rows], np.full(rows.sum(), asking))
                for k, (directions, middle, spread, shift) in enumerate(self.maps):
                    place = ((lifted @ directions - middle) / spread / 6 + 0.5).clip(0, 1) * 0.5 + shift
                    cells = (place * (1 << BITS)).astype(np.int64).clip(0, (1 << BITS) - 1)
                    key = hilbert_keys(cells, BITS)
                    yield batch[rows].drop(columns="asks").assign(curve=self.first + k, key=key, asking=asking)


def _block_search(k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        queries, others = block[block["asking"] & block["own"]], block[~block["asking"]]
        if not len(queries) or not len(others):
            return pd.DataFrame({"query": [], "point": [], "score": []}).astype({"query": "int64", "point": "int64"})
        return _nearest(queries, others, k)

    return run


def _along_curves(points: DataFrame, curves: _Curves, k: int) -> DataFrame:
    kind = points.schema["vector"].dataType.simpleString()
    keyed = points.select("point", "least_id", "vector", "asks").mapInPandas(
        curves, f"point long, least_id long, vector {kind}, curve int, key long, asking boolean"
    )
    spread = keyed.repartitionByRange("curve", "key", "point").withColumn("part", F.spark_partition_id())
    ordered = store(spread, "curve-order")
    counts = ordered.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("curve", "part").orderBy("key", "point", "asking")
    ranked = ordered.withColumn("_r", F.row_number().over(inside) - 1).join(bases, ["curve", "part"])
    rank = F.col("_r") + F.col("base")
    block, place = F.floor(rank / BLOCK), F.pmod(rank, F.lit(BLOCK))
    blocks = F.array(
        block,
        F.when((place < MARGIN) & (block > 0), block - 1),
        F.when(place >= BLOCK - MARGIN, block + 1),
    )
    copies = ranked.withColumn("home", block).withColumn("block", F.explode(F.array_compact(blocks)))
    rows = copies.filter(~F.col("asking") | (F.col("home") == F.col("block")))
    rows = rows.select("curve", "block", "point", "least_id", "vector", "asking", (F.col("home") == F.col("block")).alias("own"))
    return rows.groupBy("curve", "block").applyInPandas(_block_search(k), "query long, point long, score double")


def _best(found: DataFrame, least: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "least_id")
    joined = found.distinct().join(least, "point")
    return joined.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).select("query", "point", "score")


def _exact(points: DataFrame, asked: pd.DataFrame, k: int) -> DataFrame:
    """Brute force for a bounded number of queries, every task against its rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _nearest(asked, batch, k)

    return points.select("point", "least_id", "vector").mapInPandas(run, "query long, point long, score double")


def _all_exact(points: DataFrame, least: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of every query by brute force, a slice of the queries in each pass over the points."""
    asks = points.filter("asks")
    slices = max(1, -(-asks.count() // ASKED))
    asks = store(asks.select("point", "vector", F.pmod(F.xxhash64(F.lit(2), "point"), F.lit(slices)).alias("slice")), "asking")
    found = None
    for n in range(slices):
        asked = asks.filter(F.col("slice") == n).select("point", "vector").toPandas()
        if len(asked):
            best = store(_best(_exact(points, asked, k), least, k), "exact")
            found = best if found is None else found.union(best)
    return found


def distinct_points(df: DataFrame, id: str, vector: str, every: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Stored (point, least_id, vector, asks, ids) per distinct vector, and (query_id, point) per query."""
    rows = df.select(quoted(id).cast("long").alias("id"), quoted(vector).alias("vector")).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("size", F.size("vector"))
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).limit(1).select("size")
    # -0.0 counts as 0.0
    rows = rows.join(common, "size", "left_semi").withColumn("point", F.xxhash64(F.transform("vector", lambda x: x + F.lit(0.0).cast("float"))))
    asks = F.pmod(F.col("id"), F.lit(every)) == 0
    few = rows.select("point", "id").withColumn("_r", F.row_number().over(W.partitionBy("point").orderBy("id"))).filter(F.col("_r") <= k)
    ids = few.groupBy("point").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = rows.groupBy("point").agg(F.first("vector").alias("vector"), F.min("id").alias("least_id"), F.max(asks).alias("asks"))
    return store(vectors.join(ids, "point"), "points"), store(rows.filter(asks).select(F.col("id").alias("query_id"), "point"), "queries")


def nearest(df: DataFrame, id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of every row whose id is
    divisible by ``every``, without itself."""
    points, queries = distinct_points(df, id, vector, every, k + 1)
    least = points.select("point", "least_id")
    fit = points.orderBy(F.xxhash64("point")).limit(FIT_ROWS).select("vector").toPandas()
    found = None
    if len(fit):
        norm = points.agg(F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))).first()[0]
        asked = points.filter("asks").orderBy(F.xxhash64(F.lit(1), "point")).limit(SAMPLE).select("point", "vector").toPandas()
        sample = _matrix(fit["vector"])
        if len(asked):
            truth = store(_best(_exact(points, asked, k + 1), least, k + 1).select("query", "point"), "truth")
            wanted = truth.count()
            # beyond it an exact search looks at fewer rows
            enough = max(LEAST_CURVES, points.count() // (BLOCK + 2 * MARGIN))
        for first in count(0, BATCH) if len(asked) else ():
            more = _along_curves(points, _Curves(first, sample.shape[1], float(norm), sample), k + 1)
            merged = store(_best(more if found is None else found.union(more), least, k + 1), "nearest")
            if found is not None:
                discard(found)
            found = merged
            if truth.join(found, ["query", "point"], "left_semi").count() >= RECALL * wanted:
                break
            if first + BATCH >= enough:
                discard(found)
                found = _all_exact(points, least, k + 1)
                break
    if found is None:
        found = points.select(F.col("point").alias("query"), "point", F.lit(0.0).alias("score")).limit(0)
    rows = found.join(points.select("point", F.explode("ids").alias("vec_id")), "point")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    lists = top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("all"))
    others = F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    listed = queries.join(lists, queries["point"] == lists["query"]).select("query_id", F.posexplode(others).alias("at", "x"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
