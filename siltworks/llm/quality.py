r"""Quality rules: robust multivariate outliers per language and source, in DataFrame operations only.

Every document gets base statistics of its whole text, two base rules, and a vector of
transformed statistics.  Per language and source a minimum-covariance-determinant estimate
is fitted: the mean and covariance of the ``SUPPORT`` share of documents whose covariance
determinant is smallest, found by concentration steps from robust starts.  Documents whose
squared Mahalanobis distance to their group's estimate exceeds ``CUTOFF``, the chi-square
quantile of ``CONFIDENCE`` for that many statistics, are rejected.

A concentration step is one aggregation: distances fall into fine logarithmic bins, the
moments of the rows are summed per group and bin, and the innermost bins that hold the
share give the next estimate.  No task sees a group's rows together.  Transformed values
are rounded to 1/1024 so that sums do not depend on the order of rows.

Words are runs of ``[^\x20\x09-\x0D]``.  Defined results: a null text has no words; rows
with null language or source form groups of their own; rows of groups below ``MIN_ROWS`` fitted
rows are judged by the estimate of all rows of their language, or of the whole table where the
language is below it too; if the whole table is, only the base rules hold; repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.tables import fresh, positional, quoted, store

SUPPORT = 0.75
MIN_ROWS = 100
STEPS = 6
UNIT = 1024

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "[#*$%&|<>]"
_CAPITALS = r"\p{Lu}{2,}"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: the transformed statistics with the least standard deviation granted to each: what chance moves
#: it by in a short document.  1/sqrt(100 words); spread of word lengths of half their mean over
#: 100 words; one symbol and one run of capitals in 300 words; the root of a share of ten lines;
#: one chance repetition, of six words, in 100
FEATURES = {"size": 0.1, "word_length": 0.05, "symbols": 0.3, "capitals": 0.3, "dup_lines": 0.15, "repeats": 0.06}
#: share of normally spread documents that stay
CONFIDENCE = 0.999


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``STATISTICS``, ``n_lines``, ``n_capitals`` (runs of two or more capitals)
    and ``base_failed``; every column of ``df`` stays.

    A column of ``df`` with one of these names is replaced.
    """
    added = [*STATISTICS, "n_lines", "n_capitals", "base_failed"]
    df = df.drop(*[c for c in df.columns if c.lower() in added])
    t, w, g, r, lines = (fresh(n, df.columns) for n in ("_t", "_w", "_g", "_r", "_l"))
    body = df.withColumn(t, F.coalesce(quoted(text), F.lit("")))
    split = body.withColumns(
        {
            w: F.array_remove(F.split(t, _SPACE, -1), ""),
            lines: F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "n_symbols": (F.size(F.split(t, _SYMBOLS, -1)) - 1).cast("long"),
            "n_capitals": (F.size(F.split(t, _CAPITALS, -1)) - 1).cast("long"),
        }
    )
    counted = split.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.char_length(F.array_join(w, "")).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            # three-word windows by hash; a window found once needs no position
            g: F.transform(
                F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
                lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
            ),
        }
    ).drop(t, w, lines)
    found = counted.withColumn(
        r,
        F.when(
            F.size(F.array_distinct(g)) < F.size(g),
            F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop(g)
    again = F.filter(
        F.transform(
            r,
            lambda s, k: F.when(
                (s["h"] == F.get(r, k - 1)["h"]) | (s["h"] == F.get(r, k + 1)["h"]), s["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda i: F.array(i, i + 1, i + 2)))))
    repeated = found.withColumn("n_repeat_words", F.when(F.col(r).isNull(), 0).otherwise(covered).cast("long")).drop(r)
    few = F.col("n_words") < 50
    return repeated.withColumn("base_failed", few | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def feature_columns() -> dict[str, Column]:
    """Transformed statistics in steps of 1/UNIT."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    values = {
        "size": F.log1p(words),
        "word_length": F.log(chars / words),
        "symbols": F.log1p(100 * F.col("n_symbols") / words),
        "capitals": F.log1p(100 * F.col("n_capitals") / words),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "repeats": F.col("n_repeat_words") / words,
    }
    return {name: F.round(value * UNIT).cast("double") for name, value in values.items()}


def fit_groups(stats: DataFrame, lang: str, source: str, min_rows: int) -> DataFrame:
    """(lang, source, group, names): the group whose estimate judges every language and source,
    and the names of all groups its rows could be fitted in.

    Only documents that pass the base rules are fitted, so only they count.
    """
    key = [quoted(lang).alias("_lang"), quoted(source).alias("_source")]
    sizes = stats.groupBy(*key).agg(F.sum((~F.col("base_failed")).cast("long")).alias("n"))
    of_lang = F.sum("n").over(W.partitionBy("_lang"))
    own, whole = F.to_json(F.array("_lang", "_source")), F.to_json(F.array("_lang"))
    name = F.when(F.col("n") >= min_rows, own).when(of_lang >= min_rows, whole).otherwise("all")
    return sizes.select("_lang", "_source", name.alias("_group"), F.array(own, whole, F.lit("all")).alias("_names"))


_NAMES = list(FEATURES)
_PAIRS = list(combinations_with_replacement(_NAMES, 2))


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(a).alias(f"s_{a}") for a in _NAMES],
        *[F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in _PAIRS],
    )


def _factor(estimate: DataFrame, widen: float) -> DataFrame:
    """Means and the inverse of the covariance's triangular root, from summed moments.

    The variance that every feature is granted at least is added to the diagonal, so the
    covariance is regular also where a statistic does not vary.
    """
    n = F.col("n").cast("double")
    out = estimate.select("_group", *[(F.col(f"s_{a}") / n).alias(f"m_{a}") for a in _NAMES], "n", *[f"s_{a}_{b}" for a, b in _PAIRS])
    for j, b in enumerate(_NAMES):  # Cholesky, column by column
        for a in _NAMES[j:]:
            value = (F.col(f"s_{b}_{a}") / n - F.col(f"m_{b}") * F.col(f"m_{a}")) * widen
            if a == b:
                value = F.greatest(value, F.lit(0.0)) + (FEATURES[a] * UNIT) ** 2
            for c in _NAMES[:j]:
                value = value - F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}")
            out = out.withColumn(f"l_{a}_{b}", F.sqrt(F.greatest(value, F.lit(1e-9))) if a == b else value / F.col(f"l_{b}_{b}"))
    return out.select("_group", *[f"m_{a}" for a in _NAMES], *[f"l_{a}_{b}" for j, b in enumerate(_NAMES) for a in _NAMES[j:]])


def with_distance(rows: DataFrame, estimates: DataFrame, name: str) -> DataFrame:
    """Add the squared Mahalanobis distance to the estimate of the row's group, null if it has none."""
    out = rows.join(estimates, "_group", "left")
    for j, a in enumerate(_NAMES):  # forward substitution
        value = F.col(a) - F.col(f"m_{a}")
        for c in _NAMES[:j]:
            value = value - F.col(f"l_{a}_{c}") * F.col(f"z_{c}")
        out = out.withColumn(f"z_{a}", value / F.col(f"l_{a}_{a}"))
    total = sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in _NAMES), F.lit(0.0))
    drop = [f"m_{a}" for a in _NAMES] + [f"z_{a}" for a in _NAMES] + [f"l_{a}_{b}" for j, b in enumerate(_NAMES) for a in _NAMES[j:]]
    return out.withColumn(name, total).drop(*drop)


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges as the first estimate, given as moments of one row."""
    quartiles = rows.groupBy("_group").agg(*[F.percentile(a, [0.25, 0.5, 0.75]).alias(a) for a in _NAMES])
    middle = {a: F.col(a)[1] for a in _NAMES}
    spread = {a: (F.col(a)[2] - F.col(a)[0]) / 1.349 for a in _NAMES}
    return quartiles.select(
        "_group",
        F.lit(1).alias("n"),
        *[middle[a].alias(f"s_{a}") for a in _NAMES],
        *[(middle[a] * middle[b] + (spread[a] * spread[a] if a == b else F.lit(0.0))).alias(f"s_{a}_{b}") for a, b in _PAIRS],
    )


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Moments of the innermost ``SUPPORT`` share of every group under ``estimates``."""
    far = with_distance(rows, estimates, "_d").withColumn("_bin", F.floor(F.log2(F.col("_d") + 1e-6) * 16))
    bins = _moments(far, ["_group", "_bin"])
    group = W.partitionBy("_group")
    below = F.coalesce(F.sum("n").over(group.orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inner = bins.withColumn("_below", below).withColumn("_all", F.sum("n").over(group)).filter(F.col("_below") < SUPPORT * F.col("_all"))
    return inner.groupBy("_group").agg(*[F.sum(c).alias(c) for c in inner.columns if c not in ("_group", "_bin", "_below", "_all")])


def _consistency(share: float, p: int) -> float:
    """What the covariance of the innermost share of normal rows is too small by."""
    upper = _chi2_quantile(share, p)
    return share / _chi2_cdf(upper, p + 2)


def _chi2_cdf(x: float, p: int) -> float:
    term = total = math.exp(-x / 2 + (p / 2) * math.log(x / 2) - math.lgamma(p / 2 + 1))
    k = p / 2 + 1
    while term > 1e-15 * total:
        term *= (x / 2) / k
        total += term
        k += 1
    return total


def _chi2_quantile(q: float, p: int) -> float:
    low, high = 1e-9, 200.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_cdf(middle, p) < q else (low, middle)
    return low


#: squared distance beyond which a document is rejected
CUTOFF = _chi2_quantile(CONFIDENCE, len(FEATURES))


def judge(stats: DataFrame, lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """Add ``distance`` (squared, null without an estimate) and ``kept`` to a stored table
    that has the columns of ``statistics``."""
    groups = store(fit_groups(stats, lang, source, min_rows), "fit-groups")
    same = quoted(lang).eqNullSafe(F.col("_lang")) & quoted(source).eqNullSafe(F.col("_source"))
    grouped = stats.join(groups, same).drop("_lang", "_source").withColumns(feature_columns())
    served = grouped.filter(~F.col("base_failed")).select(F.explode("_names").alias("_group"), *_NAMES)
    fitted = store(served.join(groups.select("_group").distinct(), "_group", "left_semi"), "fit-rows")
    large = fitted.join(fitted.groupBy("_group").count().filter(F.col("count") >= min_rows).select("_group"), "_group", "left_semi")
    widen = _consistency(SUPPORT, len(_NAMES))
    estimates = store(_factor(_start(large), 1.0), "estimate")
    for _ in range(STEPS):
        estimates = store(_factor(_concentrate(large, estimates), widen), "estimate")
    measured = with_distance(grouped, estimates, "distance").drop("_group", "_names", *_NAMES)
    near = F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return measured.withColumn("kept", ~F.col("base_failed") & near)


def quality_filter(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``df`` that are kept, with its columns."""
    plain, renamed = positional(df)
    wide = store(statistics(plain, renamed[text]), "statistics", sweep=True)
    kept = judge(wide, renamed[lang], renamed[source]).filter("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in renamed.items()])
