"""Profiling, audit and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, table, view
from siltworks.operators import audit as A
from siltworks.operators import clean as C
from siltworks.operators import profile as P
from siltworks.operators.collect import dedupe_first

# ---- profiling

_COUNTS = "SELECT {c} AS value, count(*) AS n, round(1e2 * count(*) / (SELECT count({d}) FROM {v}), {r}) AS pct FROM {v} WHERE {c} IS NOT NULL GROUP BY {c}"


@query("value_counts", _COUNTS.format(c="label", d="*", v="dirty", r=2), ["dirty"])
def value_counts(spark, sf):
    return P.value_counts(view(spark, sf, "dirty"), "label")


@query("value_counts_of_values", _COUNTS.format(c="label", d="label", v="dirty", r=1), ["dirty"])
def value_counts_of_values(spark, sf):
    return P.value_counts(view(spark, sf, "dirty"), "label", denominator="values", digits=1)


@query("source_modality_counts", "SELECT source, modality, count(*) AS n FROM dirty GROUP BY source, modality", ["dirty"])
def source_modality_counts(spark, sf):
    return P.source_modality_counts(view(spark, sf, "dirty"))


_LEN = "SELECT avg(length(text)) AS m, quantile_cont(length(text), 0.5) AS q50, quantile_cont(length(text), 0.95) AS q95 FROM dirty WHERE modality = 'text'"


@query("text_length_stats", f"SELECT round(m, 6) AS text_len_mean, round(q50, 6) AS text_len_median, round(q95, 6) AS text_len_p95 FROM ({_LEN})", ["dirty"])
def text_length_stats(spark, sf):
    stats = P.text_length_stats(view(spark, sf, "dirty"))
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


@query(
    "eda_stats",
    f"""
    SELECT 'total_rows' AS section, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS value FROM dirty
    UNION ALL SELECT 'modalities', modality, CAST(count(*) AS DOUBLE) FROM dirty WHERE modality IS NOT NULL GROUP BY modality
    UNION ALL SELECT 'sources', source, CAST(count(*) AS DOUBLE) FROM dirty WHERE source IS NOT NULL GROUP BY source
    UNION ALL SELECT 'labels', label, CAST(count(*) AS DOUBLE) FROM dirty WHERE label IS NOT NULL GROUP BY label
    UNION ALL SELECT 'text_len_mean', NULL, round(m, 6) FROM ({_LEN})
    UNION ALL SELECT 'text_len_median', NULL, round(q50, 6) FROM ({_LEN})
    UNION ALL SELECT 'text_len_p95', NULL, round(q95, 6) FROM ({_LEN})""",
    ["dirty"],
)
def eda_stats(spark, sf):
    return P.eda_stats(view(spark, sf, "dirty")).withColumn("value", F.round("value", 6))


@query(
    "eda_imbalance",
    """SELECT round(1e0 * max(n) / min(n), 2) AS imbalance, 1e0 * max(n) / min(n) > 3 AS high
       FROM (SELECT label, count(*) AS n FROM dirty WHERE label IS NOT NULL GROUP BY label)""",
    ["dirty"],
)
def eda_imbalance(spark, sf):
    return P.eda_imbalance(view(spark, sf, "dirty"))


def _histogram_sql(value: str, source: str, bins: int) -> str:
    return f"""
    WITH v AS (SELECT CAST({value} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL),
    e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    c AS (SELECT least(floor((x - lo) * {bins} / (hi - lo)), {bins} - 1) AS bin, count(*) AS n FROM v, e GROUP BY 1)
    SELECT CAST(g.bin AS INT) AS bin, round(lo + g.bin * (hi - lo) / {bins}, 6) AS lower, round(lo + (g.bin + 1) * (hi - lo) / {bins}, 6) AS upper,
           coalesce(c.n, 0) AS n
    FROM (SELECT unnest(range({bins})) AS bin) g CROSS JOIN e LEFT JOIN c ON c.bin = g.bin"""


def _rounded_bins(df):
    return df.withColumn("lower", F.round("lower", 6)).withColumn("upper", F.round("upper", 6))


@query("histogram_bins", _histogram_sql("length(text)", "dirty", 60), ["dirty"])
def histogram_bins(spark, sf):
    return _rounded_bins(P.histogram_bins(view(spark, sf, "dirty"), F.length("text"), 60))


@query("histogram_bins_numeric", _histogram_sql("l_extendedprice", "lineitem", 50))
def histogram_bins_numeric(spark, sf):
    return _rounded_bins(P.histogram_bins(table(spark, sf, "lineitem"), "l_extendedprice", 50))


@query("distinct_values", "SELECT DISTINCT label AS value FROM dirty WHERE label IS NOT NULL AND label <> 'unlabeled'", ["dirty"])
def distinct_values(spark, sf):
    return P.distinct_values(view(spark, sf, "dirty"), "label")


@query(
    "table_profile",
    """
    SELECT 'rows' AS section, CAST(NULL AS VARCHAR) AS key, CAST(count(*) AS DOUBLE) AS value FROM tagged
    UNION ALL SELECT 'columns', NULL, 7e0
    UNION ALL SELECT 'sources', NULL, CAST(count(DISTINCT source) AS DOUBLE) FROM tagged
    UNION ALL SELECT 'avg_confidence', NULL, round(avg(confidence), 3) FROM tagged
    UNION ALL SELECT 'low_conf_pct', NULL, round(1e2 * sum(CASE WHEN confidence < 0.75 THEN 1 ELSE 0 END) / count(*), 1) FROM tagged
    UNION ALL SELECT 'label_dist', label, CAST(count(*) AS DOUBLE) FROM tagged GROUP BY label
    UNION ALL SELECT 'modality_dist', modality, CAST(count(*) AS DOUBLE) FROM tagged GROUP BY modality""",
    ["tagged"],
)
def table_profile(spark, sf):
    return P.table_profile(view(spark, sf, "tagged"))


@query("top_sources", "SELECT source, count(*) AS n FROM dirty WHERE source IS NOT NULL GROUP BY source ORDER BY n DESC, source LIMIT 10", ["dirty"])
def top_sources(spark, sf):
    return P.top_sources(view(spark, sf, "dirty"))


@query(
    "schema_report",
    """SELECT CAST(p AS INT) AS position, name, type, CAST(least(3, (SELECT count(v) FROM (SELECT 1 AS v FROM corpus))) AS INT) AS samples
       FROM (VALUES (0, 'id', 'bigint'), (1, 'text', 'string'), (2, 'label', 'string'), (3, 'modality', 'string'), (4, 'source', 'string'), (5, 'collected_at', 'string')) t(p, name, type)""",
    ["corpus"],
)
def schema_report(spark, sf):
    report = P.schema_report(view(spark, sf, "corpus"))
    return report.withColumn("samples", F.size("sample")).drop("sample")


@query(
    "top_words",
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM corpus)
        GROUP BY word ORDER BY n DESC, word LIMIT 20""",
    ["corpus"],
)
def top_words(spark, sf):
    return P.top_words(view(spark, sf, "corpus", spread=True))


# ---- audit

_LENGTHS = "l AS (SELECT id, length(text) AS len FROM dirty WHERE text IS NOT NULL)"
_FENCE = """f AS (SELECT q1, q3, q3 - q1 AS iqr, mean, std, n_rows FROM (
    SELECT quantile_cont(len, 0.25) AS q1, quantile_cont(len, 0.75) AS q3, avg(len) AS mean, stddev_samp(len) AS std,
           (SELECT count(*) FROM dirty) AS n_rows FROM l))"""
_IQR_N = "SELECT count(*) AS n FROM l, f WHERE len < q1 - 1.5 * iqr OR len > q3 + 1.5 * iqr"
_Z_N = "SELECT count(*) AS n FROM l, f WHERE abs((len - mean) / std) > 3"


@query(
    "missing_by_column",
    """SELECT "column", n, round(1e2 * n / t, 2) AS pct FROM (
         SELECT 'text' AS "column", count(*) - count(text) AS n, count(*) AS t FROM dirty
         UNION ALL SELECT 'label', count(*) - count(label), count(*) FROM dirty
         UNION ALL SELECT 'source', count(*) - count(source), count(*) FROM dirty
         UNION ALL SELECT 'modality', count(*) - count(modality), count(*) FROM dirty) WHERE n > 0""",
    ["dirty"],
)
def missing_by_column(spark, sf):
    return A.missing_by_column(view(spark, sf, "dirty"))


_DUPS = "SELECT count(*) - count(DISTINCT text) - CASE WHEN count(*) > count(text) THEN 1 ELSE 0 END AS n, count(*) AS t FROM dirty"


@query("duplicate_count", f"SELECT n, round(1e2 * n / t, 2) AS pct FROM ({_DUPS})", ["dirty"])
def duplicate_count(spark, sf):
    return A.duplicate_count(view(spark, sf, "dirty"))


@query("length_outliers_iqr", f"WITH {_LENGTHS}, {_FENCE} SELECT n, round(1e2 * n / n_rows, 2) AS pct FROM ({_IQR_N}), f", ["dirty"])
def length_outliers_iqr(spark, sf):
    return A.length_outliers_iqr(view(spark, sf, "dirty"))


@query("length_outliers_z", f"WITH {_LENGTHS}, {_FENCE} SELECT n, round(1e2 * n / n_rows, 2) AS pct FROM ({_Z_N}), f", ["dirty"])
def length_outliers_z(spark, sf):
    return A.length_outliers_z(view(spark, sf, "dirty"))


@query(
    "length_stats",
    f"WITH {_LENGTHS}, {_FENCE} SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(mean, 6) AS mean, round(std, 6) AS std FROM f",
    ["dirty"],
)
def length_stats(spark, sf):
    stats = A.length_stats(view(spark, sf, "dirty"))
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


@query("z_scores", f"WITH {_LENGTHS}, {_FENCE} SELECT id, CAST(len AS INT) AS len, round((len - mean) / std, 6) AS z FROM l, f", ["dirty"])
def z_scores(spark, sf):
    return A.z_scores(view(spark, sf, "dirty")).withColumn("z", F.round("z", 6))


@query(
    "blank_text_count",
    r"""SELECT count(*) - count(text) AS n_null, count(*) FILTER (regexp_matches(text, '^\s*$')) AS n_blank,
               count(*) FILTER (text IS NULL OR regexp_matches(text, '^\s*$')) AS n_missing FROM dirty""",
    ["dirty"],
)
def blank_text_count(spark, sf):
    return A.blank_text_count(view(spark, sf, "dirty"))


_CLASSES = """c AS (SELECT label, count(*) AS n FROM dirty GROUP BY label),
    ratio AS (SELECT CASE WHEN count(*) >= 2 THEN round(1e0 * max(n) / min(n), 2) END AS r FROM c WHERE label <> 'unlabeled')"""


@query(
    "class_imbalance",
    f"""WITH {_CLASSES}
    SELECT 'distribution' AS metric, label, CAST(n AS DOUBLE) AS value FROM c WHERE label IS NOT NULL
    UNION ALL SELECT 'imbalance_ratio', NULL, r FROM ratio
    UNION ALL SELECT 'labeled_count', NULL, CAST(sum(n) AS DOUBLE) FROM c WHERE label IS NULL OR label <> 'unlabeled'
    UNION ALL SELECT 'unlabeled_count', NULL, CAST(sum(n) AS DOUBLE) FROM c WHERE label = 'unlabeled'
    UNION ALL SELECT 'null_label_count', NULL, CAST(sum(n) AS DOUBLE) FROM c WHERE label IS NULL""",
    ["dirty"],
)
def class_imbalance(spark, sf):
    return A.class_imbalance(view(spark, sf, "dirty"))


_GRADE = "CASE WHEN {p} >= 10 THEN 'high' WHEN {p} >= 2 THEN 'medium' WHEN {p} > 0 THEN 'low' ELSE 'none' END"


@query(
    "severity",
    f"SELECT value, n, pct, {_GRADE.format(p='pct')} AS severity FROM ({_COUNTS.format(c='source', d='*', v='dirty', r=2)})",
    ["dirty"],
)
def severity(spark, sf):
    return A.severity(P.value_counts(view(spark, sf, "dirty"), "source"))


AUDIT_SQL = f"""
    WITH {_LENGTHS}, {_FENCE}, {_CLASSES}, t AS (SELECT n_rows FROM f),
    counted AS (
        SELECT 'duplicates' AS "check", 'text' AS "column", n AS "count" FROM ({_DUPS})
        UNION ALL SELECT 'outliers_iqr', 'text', n FROM ({_IQR_N})
        UNION ALL SELECT 'outliers_z', 'text', n FROM ({_Z_N})
        UNION ALL SELECT * FROM (
            SELECT 'missing', 'text', count(*) - count(text) AS n FROM dirty
            UNION ALL SELECT 'missing', 'label', count(*) - count(label) FROM dirty
            UNION ALL SELECT 'missing', 'source', count(*) - count(source) FROM dirty) WHERE n > 0),
    shares AS (SELECT counted.*, round(1e2 * "count" / n_rows, 2) AS pct FROM counted, t)
    SELECT "check", "column", "count", pct, CAST(NULL AS DOUBLE) AS value, {_GRADE.format(p='pct')} AS severity FROM shares
    UNION ALL SELECT 'length', k, NULL, NULL, v, NULL FROM (
        SELECT unnest(['q1', 'q3', 'iqr', 'mean', 'std']) AS k, unnest([round(q1, 6), round(q3, 6), round(iqr, 6), round(mean, 6), round(std, 6)]) AS v FROM f)
    UNION ALL SELECT 'class_distribution', label, n, NULL, NULL, NULL FROM c WHERE label IS NOT NULL
    UNION ALL SELECT 'class_imbalance_ratio', NULL, NULL, NULL, r, CASE WHEN r > 3 THEN 'high' WHEN r > 1.5 THEN 'medium' ELSE 'none' END FROM ratio
    UNION ALL SELECT 'class_labeled_count', NULL, CAST(sum(n) AS BIGINT), NULL, NULL, NULL FROM c WHERE label IS NULL OR label <> 'unlabeled'
    UNION ALL SELECT 'class_unlabeled_count', NULL, CAST(sum(n) AS BIGINT), NULL, NULL, NULL FROM c WHERE label = 'unlabeled'
    UNION ALL SELECT 'class_null_label_count', NULL, CAST(sum(n) AS BIGINT), NULL, NULL, NULL FROM c WHERE label IS NULL"""


@query("audit", AUDIT_SQL, ["dirty"])
def audit(spark, sf):
    return A.audit(view(spark, sf, "dirty")).withColumn("value", F.round("value", 6))


# ---- cleaning

_BLANK = r"(text IS NULL OR regexp_matches(text, '^\s*$'))"
_COLS = "id, text, label, modality, source, collected_at"
_FILLED = "id, coalesce(text, '') AS text, coalesce(label, 'unknown') AS label, modality, coalesce(source, 'unknown') AS source, coalesce(collected_at, 'unknown') AS collected_at"
_FIRSTS = f"u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY id) AS rn FROM dirty WHERE NOT {_BLANK}) WHERE rn = 1)"
_UFENCE = "g AS (SELECT quantile_cont(length(text), 0.25) AS q1, quantile_cont(length(text), 0.75) AS q3, avg(length(text)) AS mean, stddev_samp(length(text)) AS std FROM u)"
_IN_FENCE = "length(text) BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
_IN_Z = "abs((length(text) - mean) / std) <= 3"
CLEANED = {
    "aggressive": f"ag AS (SELECT {_COLS} FROM u, g WHERE {_IN_FENCE})",
    "conservative": f"co AS (SELECT {_FILLED} FROM dirty)",
    "balanced": f"ba AS (SELECT {_FILLED} FROM u, g WHERE {_IN_Z})",
}


@query("drop_missing_text", f"SELECT {_COLS} FROM dirty WHERE NOT {_BLANK}", ["dirty"])
def drop_missing_text(spark, sf):
    return C.drop_missing_text(view(spark, sf, "dirty"))


@query("fill_missing", f"SELECT {_FILLED} FROM dirty", ["dirty"])
def fill_missing(spark, sf):
    return C.fill_missing(view(spark, sf, "dirty"))


@query("dedupe_first", f"SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY id) AS rn FROM dirty) WHERE rn = 1", ["dirty"])
def dedupe(spark, sf):
    return dedupe_first(view(spark, sf, "dirty"))


@query(
    "filter_iqr",
    f"WITH {_LENGTHS}, {_FENCE} SELECT {_COLS} FROM dirty, f WHERE length(text) BETWEEN q1 - 1.5 * iqr AND q3 + 1.5 * iqr",
    ["dirty"],
)
def filter_iqr(spark, sf):
    return C.filter_iqr(view(spark, sf, "dirty"))


@query("filter_zscore", f"WITH {_LENGTHS}, {_FENCE} SELECT {_COLS} FROM dirty, f WHERE abs((length(text) - mean) / std) <= 3", ["dirty"])
def filter_zscore(spark, sf):
    return C.filter_zscore(view(spark, sf, "dirty"))


@query("clean_aggressive", f"WITH {_FIRSTS}, {_UFENCE}, {CLEANED['aggressive']} SELECT * FROM ag", ["dirty"])
def clean_aggressive(spark, sf):
    return C.clean(view(spark, sf, "dirty"), "aggressive")


@query("clean_conservative", f"WITH {CLEANED['conservative']} SELECT * FROM co", ["dirty"])
def clean_conservative(spark, sf):
    return C.clean(view(spark, sf, "dirty"), "conservative")


@query("clean_balanced", f"WITH {_FIRSTS}, {_UFENCE}, {CLEANED['balanced']} SELECT * FROM ba", ["dirty"])
def clean_balanced(spark, sf):
    return C.clean(view(spark, sf, "dirty"), "balanced")


def _log_sql(outlier: str, action: str) -> str:
    return f"""
    WITH {_FIRSTS}, {_UFENCE}, s AS (
        SELECT (SELECT count(*) FROM dirty) AS a, (SELECT count(*) FROM dirty WHERE NOT {_BLANK}) AS b, (SELECT count(*) FROM u) AS c,
               (SELECT count(*) FROM u, g WHERE {outlier}) AS d),
    steps AS (SELECT 1 AS step, 'missing_or_blank' AS action, a AS rows_before, b AS rows_after, a FROM s
        UNION ALL SELECT 2, 'duplicates', b, c, a FROM s UNION ALL SELECT 3, '{action}', c, d, a FROM s)
    SELECT step, action, rows_before, rows_before - rows_after AS removed, rows_after, CAST(0 AS BIGINT) AS filled,
           round(1e2 * (rows_before - rows_after) / a, 2) AS pct_of_input FROM steps"""


@query("cleaning_log", _log_sql(_IN_Z, "outliers_z"), ["dirty"])
def cleaning_log(spark, sf):
    return C.cleaning_log(view(spark, sf, "dirty"), "balanced")


@query("cleaning_log_aggressive", _log_sql(_IN_FENCE, "outliers_iqr"), ["dirty"])
def cleaning_log_aggressive(spark, sf):
    return C.cleaning_log(view(spark, sf, "dirty"), "aggressive")


_HOLES = "holes AS (SELECT event_id AS id, user_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value FROM events)"


def _holes(spark, sf):
    x = F.when(F.col("event_id") % 11 != 0, F.col("value"))
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), "user_id", x.alias("value"))


@query(
    "impute_median",
    f"WITH {_HOLES} SELECT id, user_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM holes)), 6) AS value FROM holes",
)
def impute_median(spark, sf):
    return C.impute_median(_holes(spark, sf), ["value"]).withColumn("value", F.round("value", 6))


_CLIP = "CASE WHEN value IS NULL THEN NULL ELSE greatest(q1 - 1.5 * (q3 - q1), least(q3 + 1.5 * (q3 - q1), value)) END"


@query(
    "clip_iqr",
    f"""WITH {_HOLES}, q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM holes)
        SELECT id, user_id, round({_CLIP}, 6) AS value FROM holes, q""",
)
def clip_iqr(spark, sf):
    return C.clip_iqr(_holes(spark, sf), ["value"]).withColumn("value", F.round("value", 6))


@query(
    "fix",
    f"""WITH {_HOLES}, m AS (SELECT id, CAST(user_id AS DOUBLE) AS user_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM holes)) AS value FROM holes),
        d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CAST(user_id AS BIGINT) ORDER BY id) AS rn FROM m) WHERE rn = 1),
        q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM d)
        SELECT id, CAST(user_id AS BIGINT) AS user_id, round({_CLIP}, 6) AS value FROM d, q""",
)
def fix(spark, sf):
    df = _holes(spark, sf).withColumn("who", F.col("user_id").cast("string"))
    out = C.fix(df, {"missing": "median", "duplicates": "drop", "outliers": "clip_iqr"}, ["value"], text="who")
    return out.drop("who").withColumn("value", F.round("value", 6))


def _metric_sql(name: str, source: str) -> str:
    """CTE with one row of the compared metrics of a table."""
    return f"""{name}_c AS (SELECT label, count(*) AS n FROM {source} GROUP BY label),
    {name}_l AS (SELECT avg(length(text)) AS mean, stddev_samp(length(text)) AS std FROM {source}),
    {name} AS (SELECT CAST(count(*) AS DOUBLE) AS "rows", CAST(count(*) FILTER ({_BLANK}) AS DOUBLE) AS missing_or_blank,
        CAST(count(*) - count(DISTINCT text) - CASE WHEN count(*) > count(text) THEN 1 ELSE 0 END AS DOUBLE) AS duplicates,
        (SELECT CAST(count(*) FILTER (abs((length(text) - mean) / std) > 3) AS DOUBLE) FROM {source}, {name}_l) AS outliers_z,
        (SELECT CASE WHEN count(*) >= 2 THEN round(1e0 * max(n) / min(n), 2) END FROM {name}_c WHERE label <> 'unlabeled') AS imbalance_ratio FROM {source})"""


def _compare_sql(before: str, after: str, extra: str = "") -> str:
    parts = []
    for m in C.METRICS:
        change = "CAST(NULL AS DOUBLE)" if m == "imbalance_ratio" else f'round((a."{m}" - b."{m}") * 100 / nullif(b."{m}", 0), 1)'
        parts.append(f"""SELECT '{m}' AS metric, b."{m}" AS before, a."{m}" AS after, {change} AS change_pct{extra} FROM {before} b, {after} a""")
    return " UNION ALL ".join(parts)


@query(
    "compare_quality",
    f"WITH {_FIRSTS}, {_UFENCE}, {CLEANED['balanced']}, {_metric_sql('mb', 'dirty')}, {_metric_sql('ma', 'ba')} {_compare_sql('mb', 'ma')}",
    ["dirty"],
)
def compare_quality(spark, sf):
    df = view(spark, sf, "dirty")
    return C.compare_quality(df, C.clean(df, "balanced"))


@query(
    "class_distribution_after",
    f"""WITH {_FIRSTS}, {_UFENCE}, {CLEANED['balanced']}
        SELECT label, count(*) AS n, round(1e2 * count(*) / (SELECT count(*) FROM ba), 1) AS pct FROM ba GROUP BY label""",
    ["dirty"],
)
def class_distribution_after(spark, sf):
    return C.class_distribution_after(C.clean(view(spark, sf, "dirty"), "balanced"))


_ALL = ", ".join([_FIRSTS, _UFENCE, *CLEANED.values(), _metric_sql("mb", "dirty"), *[_metric_sql(f"m{s[:2]}", s[:2]) for s in CLEANED]])


@query(
    "compare_strategies",
    f"WITH {_ALL} " + " UNION ALL ".join(_compare_sql("mb", f"m{s[:2]}", f", '{s}' AS strategy") for s in CLEANED),
    ["dirty"],
)
def compare_strategies(spark, sf):
    return C.compare_strategies(view(spark, sf, "dirty"))


@query(
    "stage_funnel",
    f"""WITH {_FIRSTS}, {_UFENCE}, {CLEANED['balanced']},
        n AS (SELECT 0 AS position, 'raw' AS stage, count(*) AS n FROM dirty UNION ALL SELECT 1, 'cleaned', count(*) FROM ba
              UNION ALL SELECT 2, 'labeled', count(*) FROM ba WHERE label <> 'unlabeled')
        SELECT position, stage, n, (SELECT count(*) FROM dirty) - n AS dropped,
               round(1e2 * ((SELECT count(*) FROM dirty) - n) / (SELECT count(*) FROM dirty), 1) AS dropped_pct FROM n""",
    ["dirty"],
)
def stage_funnel(spark, sf):
    raw = view(spark, sf, "dirty")
    cleaned = C.clean(raw, "balanced")
    return P.stage_funnel([("raw", raw), ("cleaned", cleaned), ("labeled", cleaned.filter("label <> 'unlabeled'"))])
