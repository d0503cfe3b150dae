"""Profiling: counts, length statistics, histograms and token frequencies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.scratch import materialize
from siltworks.functions.stats import length_counts, length_profile, one_row, percent
from siltworks.functions.text import tokens
from siltworks.schema import REVIEW_THRESHOLD, UNLABELED, has


def long_rows(*triples: tuple[str, Column | None, Column]) -> Column:
    """An array of (section, key, value) structs, ready to explode from one row."""
    return F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                (F.lit(None).cast("string") if key is None else key).alias("key"),
                value.cast("double").alias("value"),
            )
            for section, key, value in triples
        ]
    )


def value_counts(df: DataFrame, col: str, denominator: str = "rows", digits: int = 2) -> DataFrame:
    """Count and share of every non-null value, most frequent first.

    ``denominator="rows"`` divides by all rows, ``"values"`` by the non-null ones.
    """
    if denominator not in ("rows", "values"):
        raise ValueError("denominator is 'rows' or 'values'")
    value = F.col(col)
    counts = df.filter(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1) if denominator == "rows" else value)).scalar()
    return counts.select("value", "n", percent(F.col("n"), total, digits).alias("pct")).orderBy(F.desc("n"), "value")


def source_modality_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source", "modality").agg(F.count(F.lit(1)).alias("n"))


def text_length_stats(df: DataFrame, modality: str | None = "text") -> DataFrame:
    """Mean, median and 95th percentile of the text length of one modality."""
    rows = df.filter(F.col("modality") == modality) if modality and has(df, "modality") else df
    return length_profile(length_counts(rows)).select(
        F.col("mean").alias("text_len_mean"),
        F.col("median").alias("text_len_median"),
        F.col("p95").alias("text_len_p95"),
    )


def eda_stats(df: DataFrame) -> DataFrame:
    """Total, counts per modality/source/label and length statistics in long form.

    One scan of the small columns gives joint counts; each distribution is summed from
    those.  Long rows instead of one-row maps keep any number of sources distributed.
    """
    joint = materialize(df.groupBy("modality", "source", "label").agg(F.count(F.lit(1)).alias("n")), "joint-counts")
    total = joint.agg(F.sum("n").cast("double").alias("value")).select(
        F.lit("total_rows").alias("section"), F.lit(None).cast("string").alias("key"), "value"
    )
    parts = [total]
    for section, col in (("modalities", "modality"), ("sources", "source"), ("labels", "label")):
        counts = joint.filter(F.col(col).isNotNull()).groupBy(col).agg(F.sum("n").cast("double").alias("value"))
        parts.append(counts.select(F.lit(section).alias("section"), F.col(col).alias("key"), "value"))
    lengths = text_length_stats(df)
    parts.append(lengths.select(F.explode(long_rows(*[(c, None, F.col(c)) for c in lengths.columns])).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def eda_imbalance(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Largest over smallest class over all labels, the unlabeled sentinel included."""
    counts = df.filter("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ratio = F.when(F.count(F.lit(1)) >= 2, F.max("n") / F.min("n"))
    return counts.agg(ratio.alias("raw")).select(
        F.round("raw", 2).alias("imbalance"), F.coalesce(F.col("raw") > threshold, F.lit(False)).alias("high")
    )


def histogram_bins(df: DataFrame, value: str | Column, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed, empty bins are kept."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    values = df.select(x.alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    span = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = one_row(
        span.select(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    place = F.least(F.floor((F.col("x") - edges["lo"]) * bins / (edges["hi"] - edges["lo"])), F.lit(bins - 1))
    counts = values.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (edges["hi"] - edges["lo"]) / bins
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # counts holds at most `bins` rows
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (edges["lo"] + F.col("bin") * width).alias("lower"),
        (edges["lo"] + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def distinct_values(df: DataFrame, col: str, skip: tuple[str, ...] = (UNLABELED,)) -> DataFrame:
    """Sorted distinct non-null values without the skipped sentinels (class discovery)."""
    values = df.select(F.col(col).alias("value")).filter("value IS NOT NULL")
    if skip:
        values = values.filter(~F.col("value").isin(*skip))
    return values.distinct().orderBy("value")


def table_profile(df: DataFrame, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """Rows, columns, distributions, sources and confidence of a table, in long form."""
    keys = [c for c in ("label", "modality", "source") if has(df, c)]
    aggregates = [F.count(F.lit(1)).alias("n")]
    if has(df, "confidence"):
        aggregates += [
            F.sum("confidence").alias("s"),
            F.count("confidence").alias("c"),
            F.count_if(F.col("confidence") < threshold).alias("low"),
        ]
    joint = materialize(df.groupBy(*keys).agg(*aggregates), "joint-counts")
    triples = [("rows", None, F.sum("n")), ("columns", None, F.lit(len(df.columns)))]
    if "source" in keys:
        triples.append(("sources", None, F.count_distinct("source")))
    if has(df, "confidence"):
        triples.append(("avg_confidence", None, F.round(F.try_divide(F.sum("s"), F.sum("c").cast("double")), 3)))
        triples.append(("low_conf_pct", None, percent(F.sum("low"), F.sum("n"), 1)))
    parts = [joint.agg(long_rows(*triples).alias("r")).select(F.explode("r").alias("r")).select("r.*")]
    for section, col in (("label_dist", "label"), ("modality_dist", "modality")):
        if col in keys:
            counts = joint.filter(F.col(col).isNotNull()).groupBy(col).agg(F.sum("n").cast("double").alias("value"))
            parts.append(counts.select(F.lit(section).alias("section"), F.col(col).alias("key"), "value"))
    return reduce(DataFrame.unionByName, parts)


def top_sources(df: DataFrame, n: int = 10) -> DataFrame:
    counts = df.filter("source IS NOT NULL").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "source").limit(n)


def schema_report(df: DataFrame, rows: int = 3) -> DataFrame:
    """Column position, name, type and up to ``rows`` sample values."""
    sample = df.limit(rows).agg(*[F.collect_list(F.col(c).cast("string")).alias(c) for c in df.columns])
    described = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("sample"))
        for i, f in enumerate(df.schema.fields)
    ]
    return sample.select(F.explode(F.array(*described)).alias("r")).select("r.*")


def top_words(df: DataFrame, n: int = 20, col: str = "text") -> DataFrame:
    # the outer form avoids an inferred size(...) > 0 filter that would tokenize twice
    words = df.select(F.explode_outer(tokens(F.col(col))).alias("word")).filter("word IS NOT NULL")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(n)


def stage_funnel(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows per stage, and how many were dropped against the first stage."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("position"), F.lit(name).alias("stage"), "n")
        for i, (name, df) in enumerate(stages)
    ]
    # one row per stage, so the window over all of them is tiny
    first = F.first("n").over(W.orderBy("position"))
    rows = reduce(DataFrame.unionByName, counts).withColumn("_first", first)
    dropped = F.col("_first") - F.col("n")
    return rows.select("position", "stage", "n", dropped.alias("dropped"), percent(dropped, F.col("_first"), 1).alias("dropped_pct"))
