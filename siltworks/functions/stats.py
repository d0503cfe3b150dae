"""Statistics that stay cheap at any row count.

The pattern is the same everywhere: collapse rows into a small keyed count table
with a map-side combine, then work on that.  One-row results go back into plans as
scalar subqueries, so there are no cross joins and nothing passes through Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.scratch import materialize
from siltworks.functions.text import fingerprint, is_blank


def one_row(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct-valued scalar subquery."""
    return df.select(F.struct("*")).scalar()


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits)


def text_groups(df: DataFrame, text: str = "text", id: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """One narrow row per distinct text: first id, length, blank flag, copies.

    NULL texts form one group.  Copies of a hot text collapse before the shuffle and
    the text itself never leaves its scan task.  ``by`` adds further grouping columns.
    """
    t = F.col(text)
    return (
        df.select(
            fingerprint(t).alias("fp"),
            F.col(id).alias("_id") if id in df.columns else F.lit(None).cast("long").alias("_id"),
            F.length(t).cast("long").alias("len"),
            is_blank(t).alias("blank"),
            *by,
        )
        .groupBy("fp", *by)
        .agg(
            F.min("_id").alias("first_id"),
            F.max("len").alias("len"),
            F.max("blank").alias("blank"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def stored_groups(df: DataFrame, text: str = "text", id: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """``text_groups`` written once to shared storage.

    Several figures are always derived from the groups.  Each would prune other columns,
    which defeats exchange reuse, so storing this narrow table is what keeps the text
    at a single scan.
    """
    return materialize(text_groups(df, text, id, by), "text-groups")


def length_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(len, n): at most one row per distinct text length."""
    return (
        df.filter(F.col(text).isNotNull())
        .groupBy(F.length(text).cast("long").alias("len"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def regroup_lengths(groups: DataFrame, weight: Column | None = None) -> DataFrame:
    """Length counts from ``text_groups`` rows; ``weight`` defaults to the copies."""
    return (
        groups.filter(F.col("len").isNotNull())
        .groupBy("len")
        .agg(F.sum(F.col("n") if weight is None else weight).alias("n"))
    )


def length_profile(counts: DataFrame) -> DataFrame:
    """One row of length statistics with linear-interpolated exact quantiles.

    The quantile state holds one counter per distinct length and is fed by rows that
    are already grouped by length.  Power sums are exact integers, centred on the whole
    part of the mean before the division, so the deviation needs no second pass and is
    exactly zero for equal lengths.
    """
    n, length = F.col("n").cast("decimal(20,0)"), F.col("len").cast("decimal(18,0)")
    sums = counts.agg(
        F.sum("n").alias("total"),
        F.sum((n * length).cast("decimal(38,0)")).alias("s1"),
        F.sum((n * length * length).cast("decimal(38,0)")).alias("s2"),
        F.percentile(F.col("len"), F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75, 0.95)]), F.col("n")).alias("q"),
    )
    total = F.col("total").cast("double")
    centred = sums.withColumn("c", F.floor(F.try_divide(F.col("s1").cast("double"), total)).cast("decimal(18,0)"))
    rows = F.col("total").cast("decimal(20,0)")
    d1 = (F.col("s1") - (F.col("c") * rows).cast("decimal(38,0)")).cast("double")
    cross = (F.col("c") * F.lit(2) * F.col("s1")).cast("decimal(38,0)")
    d2 = (F.col("s2") - cross + (F.col("c") * F.col("c") * rows).cast("decimal(38,0)")).cast("double")
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(2))
    return centred.select(
        "total",
        F.try_divide(F.col("s1").cast("double"), total).alias("mean"),
        F.when(total > 1, F.sqrt(F.greatest(F.lit(0.0), F.try_divide(d2 - d1 * F.try_divide(d1, total), total - 1)))).alias("std"),
        q1.alias("q1"),
        F.get("q", F.lit(1)).alias("median"),
        q3.alias("q3"),
        F.get("q", F.lit(3)).alias("p95"),
        (q3 - q1).alias("iqr"),
        (q1 - 1.5 * (q3 - q1)).alias("low"),
        (q3 + 1.5 * (q3 - q1)).alias("high"),
    )


def outside_fence(length: Column, profile: Column) -> Column:
    return (length < profile["low"]) | (length > profile["high"])


def outside_z(length: Column, profile: Column, k: float = 3.0) -> Column:
    """abs(z) > k; never true when the deviation is zero or undefined."""
    z = F.try_divide(length - profile["mean"], profile["std"])
    return F.coalesce(F.abs(z) > k, F.lit(False))


def exact_quantiles(df: DataFrame, column: str, probs: list[float], bound: int = 1_000_000, accuracy: int = 10000) -> list[float | None]:
    """Exact linear-interpolated quantiles of one numeric column; see ``column_quantiles``."""
    return column_quantiles(df, [column], probs, bound, accuracy)[column]


def column_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], bound: int = 1_000_000, accuracy: int = 10000
) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of any number of numeric columns in common passes.

    Columns of up to ``bound`` values are left to the built-in exact percentile, in one job.
    All wanted order statistics of all other columns are closed in together: one pass counts values per
    column, interval and equal step, every statistic goes on in the step that holds it, and
    statistics of a column that lie in one interval share its counts.  A heavy value among many
    others costs nothing extra.  The number of passes depends on the values only, not on
    how many columns or quantiles there are; ``accuracy`` steps are shared out among the
    intervals, so the counts that reach the driver stay bounded too.
    """
    if not columns:
        return {}
    cell = [quoted_double(c) for c in columns]
    heads = df.agg(*[F.struct(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).alias(f"c{i}") for i, v in enumerate(cell)]).first()
    out: dict[str, list[float | None]] = {}
    few = [i for i in range(len(columns)) if 0 < heads[i]["n"] <= bound]
    if few:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(cell[i], wanted).alias(f"c{i}") for i in few]).first()
        out |= {columns[i]: list(row[f"c{i}"]) for i in few}
    many = [i for i in range(len(columns)) if heads[i]["n"] > bound]
    ranks = {i: sorted({r for p in probs for r in (math.floor(p * (heads[i]["n"] - 1)), math.ceil(p * (heads[i]["n"] - 1)))}) for i in many}
    found = _order_statistics(df, cell, {i: (heads[i]["low"], heads[i]["high"], ranks[i]) for i in many}, accuracy)
    for i in many:
        at = [p * (heads[i]["n"] - 1) for p in probs]
        low = [found[i, math.floor(x)] for x in at]
        high = [found[i, math.ceil(x)] for x in at]
        out[columns[i]] = [a + (b - a) * (x - math.floor(x)) if a != b else a for a, b, x in zip(low, high, at)]
    return {c: out.get(c, [None] * len(probs)) for c in columns}


def quoted_double(name: str) -> Column:
    """A column as double, by its exact name; NaN counts as missing."""
    value = F.col("`" + name.replace("`", "``") + "`").cast("double")
    return F.when(~F.isnan(value), value)


def _order_statistics(df: DataFrame, cells: list[Column], wanted: dict[int, tuple[float, float, list[int]]], accuracy: int) -> dict[tuple[int, int], float]:
    """{(column, rank): value} for ranks counted from 0, given each column's extremes."""
    found: dict[tuple[int, int], float] = {}
    # (column, low, high, values below) -> the ranks to find there
    open_: dict[tuple[int, float, float, int], list[int]] = {(i, low, high, 0): ranks for i, (low, high, ranks) in wanted.items()}
    while True:
        for key in [k for k in open_ if k[1] == k[2]]:
            found |= {(key[0], r): key[1] for r in open_.pop(key)}
        if not open_:
            return found
        keys = list(open_)
        bins = max(16, accuracy // len(keys))
        table = df.sparkSession.createDataFrame([(n, *k[:3]) for n, k in enumerate(keys)], "interval int, c int, low double, high double")
        used = sorted({k[0] for k in keys})
        long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), cells[i].alias("v")) for i in used])).alias("e")).select("e.c", "e.v")
        inside = long.filter("v IS NOT NULL").join(F.broadcast(table), "c").filter("v BETWEEN low AND high")
        width = F.col("high") / bins - F.col("low") / bins
        # values too close together to be divided are counted one by one, infinite ones too
        step = F.when((width > 1e-300) & (width < float("inf")), F.least(F.floor(F.col("v") / width - F.col("low") / width), F.lit(bins - 1)).cast("double"))
        counts = inside.withColumn("step", F.coalesce(step, "v")).groupBy("interval", "step").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        steps: dict[int, list] = {}
        for row in counts.collect():
            steps.setdefault(row["interval"], []).append(row)
        closer: dict[tuple[int, float, float, int], list[int]] = {}
        for n, key in enumerate(keys):
            below, left = key[3], list(open_[key])
            for row in sorted(steps[n], key=lambda r: r["low"]):
                here = [r for r in left if r < below + row["n"]]
                if here:
                    closer.setdefault((key[0], row["low"], row["high"], below), []).extend(here)
                    left = left[len(here) :]
                below += row["n"]
        open_ = closer


def running_totals(df: DataFrame, order: str, columns: list[str], block: int = 65536) -> DataFrame:
    """Running sums over a dense integer ``order`` without a one-task window on rows.

    Blocks hold at most ``block`` rows each; only one row per block is ranked globally.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    sums = blocked.groupBy("_block").agg(*[F.sum(c).alias(f"_s_{c}") for c in columns])
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_block", *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in columns])
    within = W.partitionBy("_block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = blocked.select("*", *[F.sum(c).over(within).alias(f"_r_{c}") for c in columns])
    joined = local.join(offsets, "_block")
    return joined.select(*df.columns, *[(F.col(f"_r_{c}") + F.col(f"_o_{c}")).alias(f"running_{c}") for c in columns])
