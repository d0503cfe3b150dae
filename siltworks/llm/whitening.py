r"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation over a distributed table.

Entries become integers ``floor(1024 c) + 100000``; the matrix X holds the rows less their
mean.  From a unit vector v the recurrence alternates ``u = X v`` and ``v = X'u``, each made
orthogonal to all of its kind before it, which turns X into a small bidiagonal matrix B
with ``X V = U B``.  The singular values and right vectors of B give the principal
components and their deviations.

Every left vector lies in the range of X and is held as the d numbers w with ``u = X w``;
it is formed row by row inside the tasks and never stored.  One pass over the table computes
``u = X w`` and ``X'u`` and sums, per partition and then by a shuffle, d + 1 numbers.  Inner
products with earlier left vectors are ``w . X'u``, so the reorthogonalisation on that side
needs no more data, and a vector that is not orthogonal enough gets a second pass.  The
driver holds d x d numbers at most.

A recurrence that breaks down (equal eigenvalues, low rank) goes on with a new random
vector orthogonal to all earlier ones.  It ends when the wanted components have converged
and all the variance outside what was searched is less than the least of them, so none can have
been missed, or after d steps.

Defined results: vectors that are null, or hold null or non-finite entries or such of
2^39 and more, take no part, nor do vectors of another length than the most common one (the longer
one, if two are); repeated rows count as often as they occur; components without variance
are not returned, so one row or equal rows give none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import quoted, store

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = float(1 << 39)
#: inner products of unit vectors beyond this call for another orthogonalisation
ORTHOGONAL = 1e-13
CONVERGED = 1e-14
VANISHED = 1e-12


def integer_rows(df: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the stored rows that take part, as arrays of long."""
    values = df.select(quoted(id).alias("vec_id"), quoted(vector).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)) & (F.size("v") > 0)
    whole = values.filter(F.col("v").isNotNull() & sound)
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    rows = store(whole.select("vec_id", x.alias("x")), "whitening-rows")
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(2).collect()
    return rows if len(sizes) < 2 else rows.filter(F.size("x") == sizes[0]["size"])


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _summed(rows: DataFrame, work, kind: str) -> list:
    """Sum arrays of numbers that ``work`` makes of a partition's batches, entry by entry.

    One array per partition leaves a task; the sums are shuffled by entry.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                total = made if total is None else [a + b for a, b in zip(total, made)]
        if total is not None:
            column = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)) if kind == "decimal(38,0)" else pa.array([float(t) for t in total])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), column], ["i", "value"])

    parts = rows.select("x").mapInArrow(partial, f"i int, value {kind}")
    found = parts.groupBy("i").agg(F.sum("value").alias("value")).collect()
    return [r["value"] for r in sorted(found, key=lambda r: r["i"])]


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension."""
    width = rows.select(F.size("x")).head()
    if width is None:
        return 0, []
    d = width[0]
    found = _summed(rows, lambda b: [b.num_rows, *[int(s) for s in _matrix(b, d).sum(axis=0)]], "decimal(38,0)")
    return int(found[0]), [int(s) for s in found[1:]]


def _mean(n: int, sums: list[int]) -> np.ndarray:
    return np.array([s / n for s in sums])


def product(rows: DataFrame, mean: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """``X'u`` and ``u'u`` for the left vector ``u = X w``: one pass over the rows."""
    d = len(mean)

    def work(batch: pa.RecordBatch) -> np.ndarray:
        centred = _matrix(batch, d) - mean
        u = centred @ w
        return np.append(centred.T @ u, u @ u)

    found = np.array(_summed(rows, work, "double"))
    return found[:d], float(found[d])


def total_variance(rows: DataFrame, mean: np.ndarray) -> float:
    """Sum of all squared centred entries."""
    return _summed(rows, lambda b: [((_matrix(b, len(mean)) - mean) ** 2).sum()], "double")[0]


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            vector = vector - (b @ vector) * b
    return vector


def bidiagonalise(rows: DataFrame, mean: np.ndarray, variance: float, wanted: int = COMPONENTS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Singular values (falling) and right singular vectors (as columns) of the centred rows."""
    d, rng, scale = len(mean), np.random.default_rng(seed), np.sqrt(variance)

    def fresh() -> np.ndarray:
        vector = _orthogonal(rng.standard_normal(d), right)
        return vector / np.linalg.norm(vector)

    right: list[np.ndarray] = []
    left: list[np.ndarray] = []  # w of every u
    images: list[np.ndarray] = []  # X'u
    alphas, betas = [], []
    v = fresh()
    while True:
        right.append(v)
        w = v.copy()
        for earlier, image in zip(left, images):  # (u, X v) = (X'u, v)
            w = w - (image @ v) * earlier
        image, square = product(rows, mean, w)
        for _ in range(2):
            overlap = np.array([earlier @ image for earlier in left])
            norm = np.sqrt(max(square, 0.0))
            if norm <= VANISHED * scale or not len(overlap) or np.abs(overlap).max() <= ORTHOGONAL * norm:
                break
            w = w - sum(o * earlier for o, earlier in zip(overlap, left))
            image, square = product(rows, mean, w)
        alpha = np.sqrt(max(square, 0.0))
        if alpha > VANISHED * scale:
            left.append(w / alpha)
            images.append(image / alpha)
            rest = _orthogonal(images[-1], right)
        else:  # X v lies among the earlier left vectors
            alpha, rest = 0.0, np.zeros(d)
            left.append(np.zeros(d))
            images.append(np.zeros(d))
        beta = float(np.linalg.norm(rest))
        alphas.append(float(alpha))
        small = np.diag(alphas) + (np.diag(betas, 1) if betas else 0)
        p, sigma, qt = np.linalg.svd(small)
        if len(right) == d:
            break
        m = min(wanted, len(sigma))
        open_ends = np.abs(beta * p[-1, :m])
        outside = variance - float((sigma**2).sum())
        if len(sigma) >= wanted and (open_ends <= CONVERGED * sigma[0]).all() and outside < sigma[wanted - 1] ** 2:
            break
        if beta > VANISHED * scale:
            v = rest / beta
        else:
            beta, v = 0.0, fresh()
        betas.append(beta)
    return sigma, np.column_stack(right) @ qt.T


def components(rows: DataFrame, n: int, sums: list[int], wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, unit eigenvectors (as columns) and shares of variance of the leading components."""
    mean = _mean(n, sums)
    variance = total_variance(rows, mean)
    if variance == 0:
        return np.zeros(0), np.zeros((len(sums), 0)), np.zeros(0)
    sigma, vectors = bidiagonalise(rows, mean, variance, wanted)
    held = int((sigma[:wanted] > VANISHED * np.sqrt(variance)).sum())
    return sigma[:held] ** 2 / n, vectors[:, :held], sigma[:held] ** 2 / variance


def _squared_deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """sum of (n x - S)^2 per row, exact: in 64 bits where they hold it, else in Python's integers."""
    d = x.shape[1]
    bound = n * int(np.abs(x).max()) + max(abs(s) for s in sums)
    if bound < 1 << 62:
        far = n * x - np.array(sums, np.int64)
        if d * int(np.abs(far).max()) ** 2 < 1 << 63:
            return pa.array((far * far).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = (n * x.astype(object) - np.array(sums, object)) ** 2
    return pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact.sum(axis=1)], pa.decimal128(38, 0))


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row per row that takes part and component: (vec_id, component, n, deviation,
    whitened, explained, identity_error).

    ``deviation`` is a decimal, null beyond 38 digits.
    """
    rows = integer_rows(df, id, vector)
    n, sums = totals(rows)
    kind = df.select(quoted(id)).schema[0].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    values, vectors, shares = components(rows, n, sums, wanted) if n else (np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    k, d = len(values), len(sums)
    if k == 0:
        return df.sparkSession.createDataFrame([], schema)
    mean, project = _mean(n, sums), vectors / np.sqrt(values)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        y = (_matrix(batch, d) - mean) @ project
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    found = np.array(_summed(rows, moments, "double"))
    centre = found[:k] / n
    covariance = found[k:].reshape(k, k) / n - np.outer(centre, centre)
    error = float(np.abs(covariance - np.eye(k)).max())

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch, d)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    _squared_deviation(x, n, sums).take(each),
                    pa.array(((x - mean) @ project).ravel()),
                    pa.array(np.tile(shares, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project_rows, schema)
