"""Registration and the views that give the tables the shapes the operators need.

A view is SQL text that runs in Spark and in the checking database alike.  ``@0`` is
an array position counted from zero, ``@array`` the array constructor.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltworks.sources.readers import spread_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

STAMP = "2024-01-01T00:00:00+00:00"

VIEWS: dict[str, str] = {
    # unified table: documents (labels where known) and all events
    "corpus": f"""
        SELECT d.doc_id * 2 AS id, d.text AS text,
               CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'bad' ELSE 'unlabeled' END AS label,
               'text' AS modality, 'scrape:' || d.source AS source, '{STAMP}' AS collected_at
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        UNION ALL
        SELECT event_id * 2 + 1, props, event_type, 'tabular', 'api:events', '{STAMP}' FROM events""",
    # corpus with NULL and blank values put in
    "dirty": """
        SELECT id,
               CASE WHEN id % 51 = 0 THEN NULL WHEN id % 51 = 1 THEN ' ' || chr(9) || ' ' ELSE text END AS text,
               CASE WHEN id % 41 = 3 THEN NULL ELSE label END AS label, modality,
               CASE WHEN id % 61 = 7 THEN NULL ELSE source END AS source, collected_at
        FROM corpus""",
    # machine-labeled documents; the already labeled ones have no confidence
    "tagged": """
        SELECT id, text,
               CASE WHEN label <> 'unlabeled' THEN label WHEN id % 3 = 0 THEN 'bad' ELSE 'good' END AS label,
               modality, source, collected_at,
               CASE WHEN label <> 'unlabeled' THEN CAST(NULL AS DOUBLE)
                    ELSE CAST((id * 7919) % 101 AS DOUBLE) / 100 END AS confidence
        FROM corpus WHERE modality = 'text'""",
    # the review queue after people went through it
    "reviewed": """
        SELECT id, text, label, modality, source, collected_at, confidence,
               CASE WHEN id % 7 = 0 THEN NULL
                    WHEN id % 5 = 0 THEN CASE WHEN label = 'good' THEN 'bad' ELSE 'good' END
                    WHEN id % 11 = 0 THEN ''
                    ELSE label END AS corrected_label
        FROM tagged WHERE confidence < 0.75""",
    # two labelings of the same documents
    "annotators": """
        SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label_a,
               CASE WHEN (quality = 1) = (doc_id % 9 <> 0) THEN 'good' ELSE 'bad' END AS label_b
        FROM labels""",
    # class probabilities
    "scored": """
        SELECT id, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2
        FROM (SELECT vec_id AS id, exp(CAST(embedding[@0] AS DOUBLE)) AS e0, exp(CAST(embedding[@1] AS DOUBLE)) AS e1,
                     exp(CAST(embedding[@2] AS DOUBLE)) AS e2 FROM embeddings) t""",
    # true class and a guess per vector; class 9 is never guessed and 'none' never true
    "predictions": """
        SELECT vec_id AS id, CAST(label AS STRING) AS label,
               CASE WHEN embedding[@0] > 0 AND label < 9 THEN CAST(label AS STRING)
                    WHEN embedding[@1] > 0.1 THEN 'none'
                    ELSE CAST((label + 3) % 9 AS STRING) END AS prediction
        FROM embeddings""",
    # learning curves: three strategies, six rounds, figures averaged from all events
    "histories": """
        SELECT CAST(iteration AS INT) AS iteration, CAST(50 + 20 * iteration AS BIGINT) AS n_labeled,
               round(avg(CASE WHEN value < 3 * (iteration + 2) THEN 1e0 ELSE 0e0 END), 4) AS accuracy,
               round(avg(CASE WHEN value < 3 * (iteration + 2) - 1 THEN 1e0 ELSE 0e0 END), 4) AS f1,
               strategy, 'text' AS modality, 'logreg' AS model
        FROM (SELECT value, user_id % 6 AS iteration,
                     CASE event_type WHEN 'click' THEN 'entropy' WHEN 'view' THEN 'margin' ELSE 'random' END AS strategy
              FROM events) t
        GROUP BY iteration, strategy""",
    # data-set catalog rows
    "catalog_rows": """
        SELECT 'set/' || CAST(doc_id AS STRING) AS id,
               @array('lang:' || lang,
                      CASE WHEN n_chars > 1000 THEN 'size_categories:1K<n<10K' ELSE 'language:' || lang END,
                      CASE WHEN lang = 'fr' THEN 'task_categories:text-classification' ELSE 'license:mit' END,
                      CASE WHEN lang = 'de' THEN 'modality:audio' ELSE 'task_categories:other' END) AS tags,
               CASE WHEN doc_id % 10 = 3 THEN NULL ELSE n_chars END AS downloads,
               CASE WHEN doc_id % 10 = 4 THEN NULL ELSE doc_id % 17 END AS likes, n_chars * 1000 AS bytes
        FROM documents""",
    # media file paths made from page ids
    "media_paths": """
        SELECT page_id, '/data/' || CASE page_id % 4 WHEN 0 THEN 'train/images/' WHEN 1 THEN 'valid/' WHEN 2 THEN 'train/' ELSE 'test/images/' END
               || 'f' || CAST(page_id AS STRING) || CASE page_id % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.webp' WHEN 3 THEN '.txt' ELSE '.jpeg' END AS path,
               html
        FROM pages""",
}
_DEPENDS = {"dirty": ["corpus"], "tagged": ["corpus"], "reviewed": ["corpus", "tagged"]}
_TABLES = re.compile(r"\b(FROM|JOIN)\s+(documents|labels|events|embeddings|pages|conversations|benchmark|lineitem)\b")


def _dialect(sql: str, spark: bool) -> str:
    sql = re.sub(r"@(\d+)", lambda m: str(int(m.group(1)) + (0 if spark else 1)), sql)
    return sql.replace("@array", "array" if spark else "list_value")


def with_views(sql: str, names: list[str], spark: bool = False) -> str:
    """``sql`` with the named views (and what they depend on) as common table expressions."""
    needed: list[str] = []
    for name in names:
        for dep in [*_DEPENDS.get(name, []), name]:
            if dep not in needed:
                needed.append(dep)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    sql = sql.strip()
    if ctes:
        sql = f"WITH {ctes},\n{sql[5:]}" if sql[:5].upper() == "WITH " else f"WITH {ctes}\n{sql}"
    return _dialect(sql, spark)


_handles: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf: str, name: str, spread: bool = False) -> DataFrame:
    """One reader per table and session, so footers are read once.

    ``spread`` is for queries that are heavy per row: a small single-file table is
    distributed over the cores first.
    """
    key = (spark.sparkContext.applicationId, sf, name, spread)
    if key not in _handles:
        path = f"{sf}/{name}.parquet"
        df = spark.read.parquet(path)
        _handles[key] = spread_small(df, path) if spread else df
    return _handles[key]


def view(spark: SparkSession, sf: str, name: str, spread: bool = False) -> DataFrame:
    sql = with_views(f"SELECT * FROM {name}", [name], spark=True)
    used = {found[1] for found in _TABLES.findall(sql)}
    frames = {base: table(spark, sf, base, spread and base == "documents") for base in used}
    return spark.sql(_TABLES.sub(r"\1 {\2}", sql), **frames)


def query(name: str, sql: str | None = None, views: list[str] | None = None):
    """Register a query under ``name``; ``sql`` is its check over the same tables."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views or [])
        return run

    return add
