"""Cleaning strategies, per-issue fixes and before/after comparison.

Cleaning is decided on one narrow row per distinct text (hash, first id, length,
copies).  Only the last step touches whole rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.scratch import materialize
from siltworks.functions.stats import (
    column_quantiles,
    length_counts,
    length_profile,
    one_row,
    outside_fence,
    outside_z,
    percent,
    regroup_lengths,
    stored_groups,
)
from siltworks.operators.audit import imbalance_ratio
from siltworks.operators.collect import dedupe_first, filter_blank, keep_first
from siltworks.operators.profile import value_counts
from siltworks.schema import TEXT_LABEL_SOURCE, UNKNOWN, has, numeric_columns

STRATEGIES = ("aggressive", "conservative", "balanced")


def drop_missing_text(df: DataFrame, text: str = "text") -> DataFrame:
    return filter_blank(df, text)


def fill_missing(df: DataFrame, text: str = "text", label_fill: str = UNKNOWN) -> DataFrame:
    """NULL text -> '', NULL label/source/collected_at -> 'unknown'."""
    fills = {c: UNKNOWN for c in TEXT_LABEL_SOURCE if has(df, c)}
    if has(df, "label"):
        fills["label"] = label_fill
    if has(df, text):
        fills[text] = ""
    return df.fillna(fills)


def _current_profile(df: DataFrame, text: str) -> Column:
    return one_row(length_profile(length_counts(df, text)))


def filter_iqr(df: DataFrame, text: str = "text") -> DataFrame:
    """Keep rows whose text length lies inside the IQR fence of the current rows."""
    profile = _current_profile(df, text)
    length = F.length(text)
    return df.filter((length >= profile["low"]) & (length <= profile["high"]))


def filter_zscore(df: DataFrame, k: float = 3.0, text: str = "text") -> DataFrame:
    """Keep abs(z) <= k; everything stays when the deviation is zero or undefined."""
    profile = _current_profile(df, text)
    usable = F.coalesce(profile["std"] > 0, F.lit(False))
    return df.filter(~usable | (F.abs(F.try_divide(F.length(text) - profile["mean"], profile["std"])) <= k))


def _usable(groups: DataFrame) -> DataFrame:
    return groups.filter(F.col("fp").isNotNull() & ~F.col("blank"))


def _check(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; use one of {STRATEGIES}")


def clean(df: DataFrame, strategy: str, text: str = "text", id: str = "id", label_fill: str = UNKNOWN) -> DataFrame:
    """Apply one of the three strategies.

    aggressive: drop missing and blank texts, drop copies, drop IQR length outliers;
    conservative: fill missing values, keep everything;
    balanced: drop blank texts, fill other columns, drop copies, drop abs(z) > 3.
    """
    _check(strategy)
    if strategy == "conservative":
        return fill_missing(df, text, label_fill)
    return _drop_rows(df, stored_groups(df, text, id), strategy, text, id, label_fill)


def _drop_rows(df: DataFrame, groups: DataFrame, strategy: str, text: str, id: str, label_fill: str = UNKNOWN) -> DataFrame:
    firsts = _usable(groups)
    profile = one_row(length_profile(regroup_lengths(firsts, F.lit(1))))
    outlier = (outside_fence if strategy == "aggressive" else outside_z)(F.length(text), profile)
    source = df if strategy == "aggressive" else fill_missing(df, text, label_fill)
    return keep_first(filter_blank(source, text).filter(~outlier), firsts, text, id)


def cleaning_log(df: DataFrame, strategy: str, text: str = "text") -> DataFrame:
    """Rows before, removed and after for every step, in one grouping of the texts."""
    _check(strategy)
    groups = stored_groups(df, text)
    if strategy == "conservative":
        total = F.coalesce(F.sum("n"), F.lit(0))
        filled = F.coalesce(F.sum(F.when(F.col("fp").isNull(), F.col("n"))), F.lit(0))
        steps = [("fill_text", total, F.lit(0), filled), ("duplicates_kept", total, F.lit(0), F.lit(0)), ("outliers_kept", total, F.lit(0), F.lit(0))]
    else:
        firsts = _usable(groups)
        profile = one_row(length_profile(regroup_lengths(firsts, F.lit(1))))
        outlier = (outside_fence if strategy == "aggressive" else outside_z)(F.col("len"), profile)
        usable = F.col("fp").isNotNull() & ~F.col("blank")
        total = F.coalesce(F.sum("n"), F.lit(0))
        texts = F.coalesce(F.sum(F.when(usable, F.col("n"))), F.lit(0))
        distinct = F.count_if(usable)
        outliers = F.count_if(usable & outlier)
        last = "outliers_iqr" if strategy == "aggressive" else "outliers_z"
        steps = [
            ("missing_or_blank", total, total - texts, F.lit(0)),
            ("duplicates", texts, texts - distinct, F.lit(0)),
            (last, distinct, outliers, F.lit(0)),
        ]
    rows = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(name).alias("action"),
            before.alias("rows_before"),
            removed.cast("bigint").alias("removed"),
            (before - removed).alias("rows_after"),
            filled.cast("bigint").alias("filled"),
            percent(removed, total).alias("pct_of_input"),
        )
        for i, (name, before, removed, filled) in enumerate(steps, 1)
    ]
    return groups.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def impute_median(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fill NULLs of numeric columns with the exact median; all medians come from common passes."""
    medians = column_quantiles(df, numeric_columns(df) if cols is None else cols, [0.5])
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, (m,) in medians.items() if m is not None}
    return df.withColumns(filled) if filled else df


def clip_iqr(df: DataFrame, cols: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """Clamp numeric columns to the IQR fence; NULL stays NULL.  All quartiles come from common passes."""
    clipped = {}
    for c, (q1, q3) in column_quantiles(df, numeric_columns(df) if cols is None else cols, [0.25, 0.75]).items():
        if q1 is not None:
            low, high = F.lit(q1 - k * (q3 - q1)), F.lit(q3 + k * (q3 - q1))
            x = F.col(c).cast("double")
            clipped[c] = F.when(x.isNotNull(), F.greatest(low, F.least(high, x)))
    return df.withColumns(clipped) if clipped else df


def fix(df: DataFrame, strategy: dict[str, str], cols: list[str] | None = None, text: str = "text", id: str = "id") -> DataFrame:
    """Per-issue strategy: missing drop/fill/median, duplicates drop/keep, outliers
    drop_iqr/drop_z/clip_iqr/keep; missing issues are left alone."""
    allowed = {
        "missing": ("drop", "fill", "median", "keep"),
        "duplicates": ("drop", "keep"),
        "outliers": ("drop_iqr", "drop_z", "clip_iqr", "keep"),
    }
    for issue, choice in strategy.items():
        if choice not in allowed.get(issue, ()):
            raise ValueError(f"unknown choice {issue}={choice!r}")
    missing = strategy.get("missing", "keep")
    if missing == "drop":
        df = drop_missing_text(df, text)
    elif missing == "fill":
        df = fill_missing(df, text)
    elif missing == "median":
        df = impute_median(df, cols)
    if strategy.get("duplicates", "keep") == "drop":
        df = dedupe_first(df, text, id)
    outliers = strategy.get("outliers", "keep")
    if outliers == "drop_iqr":
        df = filter_iqr(df, text)
    elif outliers == "drop_z":
        df = filter_zscore(df, text=text)
    elif outliers == "clip_iqr":
        df = clip_iqr(df, cols)
    return df


METRICS = ("rows", "missing_or_blank", "duplicates", "outliers_z", "imbalance_ratio")


def quality_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """One row of the compared metrics, measured the same way on every table.

    The table is read once, into (text hash, label) groups.
    """
    labeled = has(df, "label")
    stored = stored_groups(df, text, by=("label",) if labeled else ())
    groups = stored.groupBy("fp").agg(F.max("len").alias("len"), F.max("blank").alias("blank"), F.sum("n").alias("n"))
    profile = one_row(length_profile(regroup_lengths(stored)))
    empty = F.col("fp").isNull() | F.col("blank")
    ratio = imbalance_ratio(stored.groupBy("label").agg(F.sum("n").alias("n"))).scalar() if labeled else F.lit(None)
    zero = F.lit(0)
    return groups.agg(
        F.coalesce(F.sum("n"), zero).cast("double").alias("rows"),
        F.coalesce(F.sum(F.when(empty, F.col("n"))), zero).cast("double").alias("missing_or_blank"),
        F.coalesce(F.sum("n") - F.count(F.lit(1)), zero).cast("double").alias("duplicates"),
        F.coalesce(F.sum(F.when(outside_z(F.col("len"), profile), F.col("n"))), zero).cast("double").alias("outliers_z"),
        ratio.cast("double").alias("imbalance_ratio"),
    )


def _metric_rows(df: DataFrame, text: str, side: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])
    return quality_metrics(df, text).select(F.lit(side).alias("side"), F.explode(cells).alias("c")).select("side", "c.metric", "c.value")


def _compare(rows: DataFrame, side: str) -> DataFrame:
    """Before/after rows of one side; ``rows`` holds five values per measured table."""

    def pick(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("value")))

    change = F.round(F.try_divide((F.col("after") - F.col("before")) * 100, F.col("before")), 1)
    return (
        rows.groupBy("metric")
        .agg(pick("before").alias("before"), pick(side).alias("after"))
        .withColumn("change_pct", F.when(F.col("metric") != "imbalance_ratio", change))
    )


def compare_quality(before: DataFrame, after: DataFrame, text: str = "text") -> DataFrame:
    """Every metric before and after, with the change in percent (NULL from zero)."""
    return _compare(_metric_rows(before, text, "before").unionByName(_metric_rows(after, text, "after")), "after")


def class_distribution_after(df: DataFrame) -> DataFrame:
    return value_counts(df, "label", digits=1).withColumnRenamed("value", "label")


def compare_strategies(df: DataFrame, text: str = "text", id: str = "id") -> DataFrame:
    """The comparison table for all three strategies.

    The input and each cleaned version are measured once, the dropping strategies share
    one grouping of the texts, and what is combined afterwards is five values per table.
    """
    groups = stored_groups(df, text, id)
    cleaned = {s: fill_missing(df, text) if s == "conservative" else _drop_rows(df, groups, s, text, id) for s in STRATEGIES}
    sides = [_metric_rows(df, text, "before"), *[_metric_rows(after, text, s) for s, after in cleaned.items()]]
    rows = materialize(reduce(DataFrame.unionByName, sides), "metrics")
    return reduce(DataFrame.unionByName, [_compare(rows, s).withColumn("strategy", F.lit(s)) for s in STRATEGIES])
