"""Quality audit: missing values, duplicates, length outliers, class imbalance.

Everything is derived from two narrow groupings: one row per distinct text (hash,
length, copies) and one row per label carrying the NULL counts of all columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.scratch import materialize
from siltworks.functions.stats import (
    length_counts,
    length_profile,
    one_row,
    outside_fence,
    outside_z,
    percent,
    regroup_lengths,
    stored_groups,
    text_groups,
)
from siltworks.functions.text import is_blank
from siltworks.schema import UNLABELED, has


def _exact(name: str) -> Column:
    """A column by its exact name, also with a dot in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing_by_column(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column that has any."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(_exact(c).isNull()).alias(c) for c in df.columns])
    return _unpivot_missing(counts, df.columns)


def _unpivot_missing(counts: DataFrame, columns: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _exact(c).alias("n")) for c in columns])
    return (
        counts.select("_rows", F.explode(cells).alias("c"))
        .filter("c.n > 0")
        .select("c.column", "c.n", percent(F.col("c.n"), F.col("_rows")).alias("pct"))
    )


def duplicate_count(df: DataFrame, col: str = "text") -> DataFrame:
    """Rows beyond the first of every value; NULLs count as copies of each other."""
    groups = text_groups(df, col)
    return groups.agg(
        F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)).alias("n"),
        percent(F.sum("n") - F.count(F.lit(1)), F.sum("n")).alias("pct"),
    )


def _outlier_row(df: DataFrame, test: Column, counts: DataFrame) -> DataFrame:
    rows = df.agg(F.count(F.lit(1))).scalar()
    n = F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return counts.agg(n.alias("n"), percent(n, rows).alias("pct"))


def length_outliers_iqr(df: DataFrame, text: str = "text") -> DataFrame:
    """Texts whose length lies outside the IQR fence; share of all rows."""
    counts = materialize(length_counts(df, text), "length-counts")
    return _outlier_row(df, outside_fence(F.col("len"), one_row(length_profile(counts))), counts)


def length_outliers_z(df: DataFrame, k: float = 3.0, text: str = "text") -> DataFrame:
    counts = materialize(length_counts(df, text), "length-counts")
    return _outlier_row(df, outside_z(F.col("len"), one_row(length_profile(counts)), k), counts)


def length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    return length_profile(length_counts(df, text)).select("q1", "q3", "iqr", "mean", "std")


def z_scores(df: DataFrame, text: str = "text", id: str = "id") -> DataFrame:
    """Length and z-score of every non-null text."""
    profile = one_row(length_profile(length_counts(df, text)))
    length = F.length(text)
    z = F.try_divide(length - profile["mean"], profile["std"])
    return df.filter(F.col(text).isNotNull()).select(id, length.alias("len"), z.alias("z"))


def blank_text_count(df: DataFrame, text: str = "text") -> DataFrame:
    t = F.col(text)
    return df.agg(
        F.count_if(t.isNull()).alias("n_null"),
        F.count_if(is_blank(t)).alias("n_blank"),
        F.count_if(t.isNull() | is_blank(t)).alias("n_missing"),
    )


def imbalance_ratio(labels: DataFrame, digits: int | None = 2) -> DataFrame:
    """max/min over the classes of a (label, n) table, the sentinel left out."""
    classes = labels.filter(F.col("label").isNotNull() & (F.col("label") != UNLABELED))
    ratio = F.when(F.count(F.lit(1)) >= 2, F.max("n") / F.min("n"))
    return classes.agg((ratio if digits is None else F.round(ratio, digits)).alias("imbalance_ratio"))


def class_imbalance(df: DataFrame) -> DataFrame:
    """Label distribution, imbalance ratio and labeled/unlabeled counts in long form.

    Rows with a NULL label count as labeled although they belong to no class; they are
    reported separately as well.
    """
    return _class_rows(materialize(df.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "labels"))


def _class_rows(labels: DataFrame) -> DataFrame:
    unlabeled = F.sum(F.when(F.col("label") == UNLABELED, F.col("n")).otherwise(0))
    nulls = F.sum(F.when(F.col("label").isNull(), F.col("n")).otherwise(0))
    ratio = imbalance_ratio(labels).scalar()
    summary = labels.agg(
        F.array(
            F.struct(F.lit("imbalance_ratio").alias("metric"), ratio.alias("value")),
            F.struct(F.lit("labeled_count").alias("metric"), (F.sum("n") - unlabeled).cast("double").alias("value")),
            F.struct(F.lit("unlabeled_count").alias("metric"), unlabeled.cast("double").alias("value")),
            F.struct(F.lit("null_label_count").alias("metric"), nulls.cast("double").alias("value")),
        ).alias("m")
    )
    flat = summary.select(F.explode("m").alias("m")).select("m.metric", F.lit(None).cast("string").alias("label"), "m.value")
    dist = labels.filter("label IS NOT NULL").select(F.lit("distribution").alias("metric"), "label", F.col("n").cast("double").alias("value"))
    return dist.unionByName(flat)


def severity_of(value: Column, high: float, medium: float, low: float | None = None, strict: bool = False) -> Column:
    """Grade a number; NULL grades as ``none``.  ``strict`` compares with > instead of >=."""
    over = (lambda t: value > t) if strict else (lambda t: value >= t)
    grade = F.when(over(high), "high").when(over(medium), "medium")
    if low is not None:
        grade = grade.when(value > low, "low")
    return grade.otherwise("none")


def severity(df: DataFrame, pct_col: str = "pct", high: float = 10.0, medium: float = 2.0) -> DataFrame:
    return df.withColumn("severity", severity_of(F.col(pct_col), high, medium, 0.0))


def imbalance_severity(value: Column, high: float = 3.0, medium: float = 1.5) -> Column:
    return severity_of(value, high, medium, strict=True)


def audit(df: DataFrame, text: str = "text") -> DataFrame:
    """All checks as one table (check, column, count, pct, value, severity).

    The text column is scanned once (for the groups), the other columns once (for the
    label rows), and all figures are summed from those two small results.
    """
    groups = stored_groups(df, text)
    lengths = regroup_lengths(groups)
    profile = length_profile(lengths)
    p = one_row(profile)
    rows = F.sum("n")
    duplicates = rows - F.count(F.lit(1))
    missing_text = F.coalesce(F.sum(F.when(F.col("fp").isNull(), F.col("n"))), F.lit(0))
    iqr = F.coalesce(F.sum(F.when(outside_fence(F.col("len"), p), F.col("n"))), F.lit(0))
    z = F.coalesce(F.sum(F.when(outside_z(F.col("len"), p), F.col("n"))), F.lit(0))

    def share(check: str, column: str, n: Column) -> Column:
        pct = percent(n, rows)
        return _row(check, column, n, pct, None, severity_of(pct, 10.0, 2.0, 0.0))

    text_rows = groups.agg(
        F.array(
            share("duplicates", text, F.coalesce(duplicates, F.lit(0))),
            share("outliers_iqr", text, iqr),
            share("outliers_z", text, z),
            share("missing", text, missing_text),
        ).alias("r")
    )
    stat_rows = profile.select(F.array(*[_row("length", c, None, None, F.col(c), F.lit(None)) for c in ("q1", "q3", "iqr", "mean", "std")]).alias("r"))
    parts = [text_rows, stat_rows]

    others = [c for c in df.columns if c not in (text, "label")]
    if has(df, "label"):
        by_label = df.groupBy("label").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(_exact(c).isNull()).alias(f"_m_{c}") for c in others]
        )
        by_label = materialize(by_label, "labels")
        sums = [(c, F.sum(_exact(f"_m_{c}"))) for c in others]
        sums.append(("label", F.sum(F.when(F.col("label").isNull(), F.col("n")).otherwise(0))))
        parts.append(by_label.agg(F.array(*[share("missing", c, s) for c, s in sums]).alias("r")))
        classes = _class_rows(by_label.select("label", "n"))
        parts.append(
            classes.select(
                F.array(
                    _row(
                        F.concat(F.lit("class_"), F.col("metric")),
                        F.col("label"),
                        F.when(F.col("metric") != "imbalance_ratio", F.col("value")),
                        None,
                        F.when(F.col("metric") == "imbalance_ratio", F.col("value")),
                        F.when(F.col("metric") == "imbalance_ratio", imbalance_severity(F.col("value"))),
                    )
                ).alias("r")
            )
        )
    elif others:
        total = F.count(F.lit(1))
        cells = [(c, F.count_if(_exact(c).isNull())) for c in others]
        parts.append(
            df.agg(F.array(*[_row("missing", c, n, percent(n, total), None, severity_of(percent(n, total), 10.0, 2.0, 0.0)) for c, n in cells]).alias("r"))
        )
    flat = reduce(DataFrame.unionByName, [part.select(F.explode("r").alias("r")) for part in parts]).select("r.*")
    return flat.filter((F.col("check") != "missing") | (F.col("count") > 0))


def _row(check, column, count, pct, value, grade) -> Column:
    def cell(x, kind):
        return (x if isinstance(x, Column) else F.lit(x)).cast(kind)

    return F.struct(
        cell(check, "string").alias("check"),
        cell(column, "string").alias("column"),
        cell(count, "bigint").alias("count"),
        cell(pct, "double").alias("pct"),
        cell(value, "double").alias("value"),
        cell(grade, "string").alias("severity"),
    )
