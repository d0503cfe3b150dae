"""Labeling, review and label-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import STAMP, query, view
from siltworks.functions.scratch import new_path
from siltworks.operators import annotate as N
from siltworks.operators import quality as Q
from siltworks.operators import review as V
from siltworks.operators.labelsink import LabelSink

_COLS = "id, text, label, modality, source, collected_at"
CLASSES = ["good", "bad"]
RULES = {"good": "the|and|der|les", "bad": "von|que|los|ing"}


@query(
    "split_unlabeled",
    f"SELECT 'todo' AS part, {_COLS} FROM dirty WHERE label = 'unlabeled' UNION ALL SELECT 'done', {_COLS} FROM dirty WHERE label IS NULL OR label <> 'unlabeled'",
    ["dirty"],
)
def split_unlabeled(spark, sf):
    todo, done = N.split_unlabeled(view(spark, sf, "dirty"))
    return todo.withColumn("part", F.lit("todo")).unionByName(done.withColumn("part", F.lit("done")))


@query(
    "dominant_modality",
    "SELECT modality FROM (SELECT modality, count(*) AS n FROM corpus GROUP BY modality) ORDER BY n DESC, modality LIMIT 1",
    ["corpus"],
)
def dominant_modality(spark, sf):
    return N.dominant_modality(view(spark, sf, "corpus"))


# rank in hash order, ten rows per batch
_RANKED = """r AS (SELECT id, text, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) - 1 AS k FROM todo)"""
_TODO = "todo AS (SELECT id, text FROM corpus WHERE label = 'unlabeled')"
_TASK = "Quality of the text"
_HEAD = (
    f"'{_TASK}' || chr(10) || 'Allowed classes: good, bad' || chr(10) || "
    "'Answer with one JSON array holding a label and a confidence from 0 to 1 per text, in order.' || chr(10) || chr(10)"
)


def _batches(spark, sf):
    todo, _ = N.split_unlabeled(view(spark, sf, "corpus"))
    return N.label_batches(todo, CLASSES, _TASK, max_chars=None)


@query(
    "label_batches",
    f"""WITH {_TODO}, {_RANKED}
        SELECT k // 10 AS batch, count(*) AS n, {_HEAD} || string_agg(CAST(k % 10 + 1 AS VARCHAR) || '. ' || text, chr(10) ORDER BY k) AS prompt
        FROM r GROUP BY k // 10""",
    ["corpus"],
)
def label_batches(spark, sf):
    return _batches(spark, sf).select("batch", F.size("items").cast("bigint").alias("n"), "prompt")


@query(
    "label_batches_short",
    f"""WITH {_TODO}, {_RANKED}
        SELECT k // 10 AS batch, {_HEAD} || string_agg(CAST(k % 10 + 1 AS VARCHAR) || '. ' || substr(text, 1, 300), chr(10) ORDER BY k) AS prompt
        FROM r GROUP BY k // 10""",
    ["corpus"],
)
def label_batches_short(spark, sf):
    todo, _ = N.split_unlabeled(view(spark, sf, "corpus"))
    return N.label_batches(todo, CLASSES, _TASK, max_chars=300).select("batch", "prompt")


def _reply_items(x):
    """A made-up answer per item, with the usual defects."""
    i = x["id"]
    guess = F.when(i % 4 == 0, "bad").otherwise("good")
    confidence = (
        F.when(i % 17 == 0, '"0.25"').when(i % 19 == 0, "1.7").when(i % 23 == 0, "-0.5").when(i % 97 == 0, '"high"')
    ).otherwise(F.concat(F.lit("0."), (10 + i % 90).cast("string")))
    plain = F.concat(F.lit('{"label": "'), F.when(i % 11 == 0, "other").otherwise(guess), F.lit('", "confidence": '), confidence, F.lit("}"))
    return F.when(i % 13 == 0, F.concat(F.lit('{"label": "'), guess, F.lit('"}'))).otherwise(plain)


def replies(spark, sf):
    """One reply per batch, derived from the batch's own items."""
    batches = _batches(spark, sf).select("batch", "items")
    answers = F.transform("items", _reply_items)
    covered = F.when(F.col("batch") % 7 == 6, F.slice(answers, 1, 8)).otherwise(answers)
    body = F.concat(F.lit("["), F.concat_ws(", ", covered), F.lit("]"))
    reply = (
        F.when(F.col("batch") % 7 == 3, "no answer")
        .when(F.col("batch") % 7 == 5, F.concat(F.lit("Sure: "), body, F.lit(" done.")))
        .when(F.col("batch") % 7 == 4, F.concat(body, F.lit(" [")))
        .otherwise(body)
    )
    return batches.withColumn("reply", reply)


_ANSWER = """a AS (SELECT k // 10 AS batch, CAST(k % 10 + 1 AS INT) AS pos, id,
        CASE WHEN id % 13 = 0 THEN CASE WHEN id % 4 = 0 THEN 'bad' ELSE 'good' END
             WHEN id % 11 = 0 THEN 'good' WHEN id % 4 = 0 THEN 'bad' ELSE 'good' END AS label,
        CASE WHEN id % 13 = 0 THEN 0.5e0 WHEN id % 17 = 0 THEN 0.25e0 WHEN id % 19 = 0 THEN 1e0 WHEN id % 23 = 0 THEN 0e0
             WHEN id % 97 = 0 THEN NULL ELSE (10 + id % 90) / 1e2 END AS confidence,
        (k // 10) % 7 IN (0, 1, 2, 4, 5) OR ((k // 10) % 7 = 6 AND k % 10 < 8) AS covered FROM r),
    bad AS (SELECT DISTINCT batch FROM a WHERE confidence IS NULL AND covered)"""


@query(
    "parse_label_replies",
    f"""WITH {_TODO}, {_RANKED}, {_ANSWER}
        SELECT batch, pos, id, CASE WHEN ok THEN label ELSE 'good' END AS label, CASE WHEN ok THEN confidence ELSE 0e0 END AS confidence
        FROM (SELECT *, covered AND batch NOT IN (SELECT batch FROM bad) AS ok FROM a)""",
    ["corpus"],
)
def parse_label_replies(spark, sf):
    return N.parse_label_replies(replies(spark, sf), CLASSES)


@query(
    "normalize_labels",
    """SELECT id, CASE WHEN label IN ('good', 'bad') THEN label ELSE 'good' END AS label,
              greatest(0e0, least(1e0, coalesce(TRY_CAST(conf AS DOUBLE), 0.5e0))) AS confidence
       FROM (SELECT id, label, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN 'n/a' WHEN id % 3 = 0 THEN '1.5' WHEN id % 2 = 0 THEN '-2' ELSE '0.75' END AS conf FROM corpus)""",
    ["corpus"],
)
def normalize_labels(spark, sf):
    i = F.col("id")
    raw = F.when(i % 7 == 0, F.lit(None)).when(i % 5 == 0, "n/a").when(i % 3 == 0, "1.5").when(i % 2 == 0, "-2").otherwise("0.75")
    df = view(spark, sf, "corpus").select("id", "label", raw.cast("string").alias("confidence"))
    return N.normalize_labels(df, CLASSES)


_HITS = "len(regexp_extract_all(lower(coalesce(text, '')), '{p}'))"


@query(
    "auto_label",
    f"""SELECT id, CASE WHEN label <> 'unlabeled' OR label IS NULL THEN label WHEN g >= b THEN 'good' ELSE 'bad' END AS label,
              CASE WHEN label = 'unlabeled' THEN round(CASE WHEN g + b = 0 THEN 0e0 ELSE 1e0 * greatest(g, b) / (g + b) END, 6) END AS confidence
        FROM (SELECT id, label, {_HITS.format(p=RULES['good'])} AS g, {_HITS.format(p=RULES['bad'])} AS b FROM dirty)""",
    ["dirty"],
)
def auto_label(spark, sf):
    out = N.auto_label(view(spark, sf, "dirty", spread=True), CLASSES, rules=RULES)
    return out.select("id", "label", F.round("confidence", 6).alias("confidence"))


def length_labeler(texts):
    """A stand-in for a model call: decides by the length of the whole text."""
    if any("zzz" in t for t in texts):
        raise ValueError("refused")
    return [("good" if len(t) % 2 == 0 else "bad", (len(t) % 101) / 100) for t in texts]


@query(
    "auto_label_batches",
    """SELECT id, CASE WHEN label <> 'unlabeled' OR label IS NULL THEN label WHEN n % 2 = 0 THEN 'good' ELSE 'bad' END AS label,
              CASE WHEN label = 'unlabeled' THEN (n % 101) / 1e2 END AS confidence
       FROM (SELECT id, label, length(coalesce(text, '')) AS n FROM dirty)""",
    ["dirty"],
)
def auto_label_batches(spark, sf):
    return N.auto_label(view(spark, sf, "dirty", spread=True), CLASSES, length_labeler).select("id", "label", "confidence")


@query(
    "resume_labeling",
    "SELECT id, text FROM corpus WHERE label = 'unlabeled' AND id NOT IN (SELECT id FROM tagged WHERE confidence >= 0.5)",
    ["corpus", "tagged"],
)
def resume_labeling(spark, sf):
    todo, _ = N.split_unlabeled(view(spark, sf, "corpus"))
    return N.resume_labeling(todo, view(spark, sf, "tagged").filter("confidence >= 0.5")).select("id", "text")


@query(
    "append_labels",
    """SELECT id, CASE WHEN label <> 'unlabeled' OR label IS NULL THEN label WHEN n % 2 = 0 THEN 'good' ELSE 'bad' END AS label,
              CASE WHEN label = 'unlabeled' THEN (n % 101) / 1e2 END AS confidence
       FROM (SELECT id, label, length(coalesce(text, '')) AS n FROM dirty)""",
    ["dirty"],
)
def append_labels(spark, sf):
    """Labels written by a run that ends after two batches and by the one that goes on; half of the rows arrive in between."""
    df = view(spark, sf, "dirty").select("id", "text", "label", "modality")
    sink = LabelSink(spark, new_path(spark, "labels"))
    rows = max(1, df.count() // 8)
    sink.append(df.filter("id % 4 < 2"), CLASSES, length_labeler, batch_rows=rows, most_batches=2)
    sink.append(df, CLASSES, length_labeler, batch_rows=rows)
    return sink.table(df).select("id", "label", "confidence")


@query(
    "labeling_progress",
    f"""WITH {_TODO}, {_RANKED}, {_ANSWER},
        f AS (SELECT batch, CASE WHEN covered AND batch NOT IN (SELECT batch FROM bad) THEN confidence ELSE 0e0 END AS confidence FROM a),
        g AS (SELECT batch, count(*) AS n, sum(confidence) AS s FROM f GROUP BY batch)
        SELECT batch, CAST(sum(n) OVER w AS BIGINT) AS done, round(1e2 * sum(n) OVER w / (SELECT sum(n) FROM g), 1) AS done_pct,
               round(sum(s) OVER w / sum(n) OVER w + 1e-9, 6) AS avg_confidence FROM g WINDOW w AS (ORDER BY batch)""",
    ["corpus"],
)
def labeling_progress(spark, sf):
    # the tiny offset keeps exact halves from rounding by summation order
    out = N.labeling_progress(N.parse_label_replies(replies(spark, sf), CLASSES))
    return out.withColumn("avg_confidence", F.round(F.col("avg_confidence") + 1e-9, 6))


@query("needs_review", "SELECT id, confidence, coalesce(confidence < 0.75, false) AS needs_review FROM tagged", ["tagged"])
def needs_review(spark, sf):
    return N.needs_review(view(spark, sf, "tagged")).select("id", "confidence", "needs_review")


@query(
    "label_summary",
    """SELECT 'labeled_rows' AS metric, CAST(NULL AS VARCHAR) AS label, CAST(count(confidence) AS DOUBLE) AS value FROM tagged
       UNION ALL SELECT 'mean_confidence_pct', NULL, round(avg(confidence) * 100, 1) FROM tagged
       UNION ALL SELECT 'to_review', NULL, CAST(count(*) FILTER (confidence < 0.75) AS DOUBLE) FROM tagged
       UNION ALL SELECT 'distribution', label, CAST(count(*) AS DOUBLE) FROM tagged GROUP BY label""",
    ["tagged"],
)
def label_summary(spark, sf):
    return N.label_summary(view(spark, sf, "tagged"))


# ---- review

_DONE = "(corrected_label IS NOT NULL AND corrected_label <> '' AND corrected_label IS DISTINCT FROM label)"


@query("review_queue", f"SELECT {_COLS}, confidence, label AS corrected_label FROM tagged WHERE confidence < 0.75", ["tagged"])
def review_queue(spark, sf):
    return V.review_queue(view(spark, sf, "tagged"))


@query("pending_review", f"SELECT id, label, corrected_label FROM reviewed WHERE NOT {_DONE}", ["reviewed"])
def pending_review(spark, sf):
    return V.pending_review(view(spark, sf, "reviewed")).select("id", "label", "corrected_label")


@query(
    "review_progress",
    f"SELECT count(*) AS total, count(*) FILTER {_DONE} AS done, count(*) FILTER (NOT {_DONE}) AS remaining FROM reviewed",
    ["reviewed"],
)
def review_progress(spark, sf):
    return V.review_progress(view(spark, sf, "reviewed"))


@query(
    "review_stats",
    f"""SELECT t AS in_queue, c AS corrected, round(1e2 * c / t, 1) AS error_pct, round(100 - 1e2 * c / t, 1) AS accuracy_pct, 1e2 * c / t > 30 AS high_error
        FROM (SELECT count(*) AS t, count(*) FILTER {_DONE} AS c FROM reviewed)""",
    ["reviewed"],
)
def review_stats(spark, sf):
    return V.review_stats(view(spark, sf, "reviewed"))


def _merge_sql(keep: str) -> str:
    return f"""SELECT {_COLS}, confidence FROM (
        SELECT *, row_number() OVER (PARTITION BY text ORDER BY rev DESC, id DESC) AS rn FROM (
            SELECT {_COLS}, confidence, 0 AS rev FROM tagged WHERE {keep}
            UNION ALL SELECT id, text, coalesce(nullif(corrected_label, ''), label), modality, source, collected_at, confidence, 1 FROM reviewed)) WHERE rn = 1"""


@query("apply_review", _merge_sql("confidence >= 0.75 OR confidence IS NULL"), ["tagged", "reviewed"])
def apply_review(spark, sf):
    return V.apply_review(view(spark, sf, "tagged"), view(spark, sf, "reviewed"))


@query("apply_review_strict", _merge_sql("confidence >= 0.75"), ["tagged", "reviewed"])
def apply_review_strict(spark, sf):
    return V.apply_review(view(spark, sf, "tagged"), view(spark, sf, "reviewed"), strict_reference=True)


# ---- label quality

_QUALITY = """
    WITH c AS (SELECT label, count(*) AS n FROM merged GROUP BY label),
    k AS (SELECT CASE WHEN count(*) >= 2 THEN round(1e0 * max(n) / min(n), 2) END AS r FROM c WHERE label <> 'unlabeled'),
    l AS (SELECT count(*) AS n FROM merged WHERE label IS NULL OR label <> 'unlabeled')
    SELECT 'total' AS metric, CAST(NULL AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS value FROM merged
    UNION ALL SELECT 'labeled', NULL, CAST(n AS DOUBLE) FROM l
    UNION ALL SELECT 'unlabeled', NULL, CAST(count(*) AS DOUBLE) FROM merged WHERE label = 'unlabeled'
    UNION ALL SELECT 'imbalance_ratio', NULL, r FROM k
    UNION ALL SELECT 'imbalance_high', NULL, CASE WHEN r > 3 THEN 1e0 ELSE 0e0 END FROM k
    UNION ALL SELECT 'confidence_mean', NULL, round(avg(confidence), 3) FROM merged
    UNION ALL SELECT 'confidence_median', NULL, round(quantile_cont(confidence, 0.5), 3) FROM merged
    UNION ALL SELECT 'confidence_std', NULL, round(stddev_samp(confidence), 3) FROM merged
    UNION ALL SELECT 'confidence_pct_high', NULL, round(1e2 * count(*) FILTER (confidence >= 0.75) / count(confidence), 1) FROM merged
    UNION ALL SELECT 'confidence_pct_low', NULL, round(1e2 * count(*) FILTER (confidence < 0.75) / count(confidence), 1) FROM merged
    UNION ALL SELECT 'class_count', label, CAST(n AS DOUBLE) FROM c WHERE label <> 'unlabeled'
    UNION ALL SELECT 'class_pct', c.label, round(1e2 * c.n / l.n, 1) FROM c, l WHERE c.label <> 'unlabeled'"""
_MERGED = "merged AS (SELECT id, label, CAST(NULL AS DOUBLE) AS confidence FROM dirty UNION ALL SELECT id, label, confidence FROM tagged)"


def _merged(spark, sf):
    known = view(spark, sf, "dirty").select("id", "label", F.lit(None).cast("double").alias("confidence"))
    return known.unionByName(view(spark, sf, "tagged").select("id", "label", "confidence"))


@query("label_quality", f"WITH {_MERGED},{_QUALITY.strip()[4:]}", ["dirty", "tagged"])
def label_quality(spark, sf):
    return Q.label_quality(_merged(spark, sf))


@query(
    "low_confidence",
    "SELECT count(*) FILTER (confidence < 0.7) AS n_low, round(1e2 * count(*) FILTER (confidence < 0.7) / count(*), 1) AS pct_low FROM tagged",
    ["tagged"],
)
def low_confidence(spark, sf):
    return Q.low_confidence(view(spark, sf, "tagged"))


def _two(spark, sf):
    both = view(spark, sf, "annotators")
    return both.select("id", F.col("label_a").alias("label")), both.select("id", F.col("label_b").alias("label"))


@query("label_confusion", "SELECT label_a, label_b, count(*) AS n FROM annotators GROUP BY label_a, label_b", ["annotators"])
def label_confusion(spark, sf):
    return Q.label_confusion(*_two(spark, sf))


@query(
    "cohen_kappa",
    """WITH t AS (SELECT count(*) AS n, avg(CASE WHEN label_a = label_b THEN 1e0 ELSE 0e0 END) AS po FROM annotators),
       a AS (SELECT label_a AS l, count(*) AS n FROM annotators GROUP BY 1), b AS (SELECT label_b AS l, count(*) AS n FROM annotators GROUP BY 1),
       e AS (SELECT sum(1e0 * a.n * b.n) / max(1e0 * t.n * t.n) AS pe FROM a JOIN b ON a.l = b.l, t)
       SELECT n, round(po, 6) AS agreement, round((po - pe) / (1 - pe), 6) AS kappa FROM t, e""",
    ["annotators"],
)
def cohen_kappa(spark, sf):
    return Q.cohen_kappa(*_two(spark, sf))


@query(
    "class_examples",
    """SELECT label, CAST(rn AS INT) AS position, id, text FROM (
         SELECT label, id, text, row_number() OVER (PARTITION BY label ORDER BY id) AS rn FROM corpus WHERE label <> 'unlabeled') WHERE rn <= 3""",
    ["corpus"],
)
def class_examples(spark, sf):
    return Q.class_examples(view(spark, sf, "corpus"))


_MIXED = """mixed AS (SELECT id, text, label, CASE WHEN id % 3 = 0 THEN 'image' WHEN id % 3 = 1 THEN 'audio' ELSE modality END AS modality, source,
    CASE WHEN id % 5 = 0 THEN NULL ELSE (id % 100) / 1e2 END AS confidence FROM dirty)"""
_KNOWN = "(label IS NOT NULL AND label IN ('good', 'bad', 'click'))"


def _mixed(spark, sf):
    i = F.col("id")
    kind = F.when(i % 3 == 0, "image").when(i % 3 == 1, "audio").otherwise(F.col("modality"))
    conf = F.when(i % 5 != 0, (i % 100) / F.lit(100.0))
    return view(spark, sf, "dirty").withColumn("modality", kind).withColumn("confidence", conf)


@query(
    "export_tasks",
    f"""WITH {_MIXED} SELECT sha256(CAST(id AS VARCHAR)) AS task_id, CASE WHEN modality IN ('image', 'audio') THEN modality ELSE 'text' END AS data_key,
          coalesce(text, '') AS content, coalesce(source, '') AS source, CASE WHEN {_KNOWN} THEN label END AS choice,
          CASE WHEN {_KNOWN} THEN coalesce(confidence, 1e0) END AS score FROM mixed""",
    ["dirty"],
)
def export_tasks(spark, sf):
    """Fields are read back out of the exported JSON."""
    tasks = Q.export_tasks(_mixed(spark, sf), ["good", "bad", "click"])
    schema = (
        "id string, data struct<image:string,audio:string,text:string,source:string>, "
        "predictions array<struct<score:double,result:array<struct<value:struct<choices:array<string>>,to_name:string>>>>"
    )
    t = tasks.select(F.from_json("task_json", schema).alias("t"))
    key = F.when(F.col("t.data.image").isNotNull(), "image").when(F.col("t.data.audio").isNotNull(), "audio").otherwise("text")
    first = F.get("t.predictions", F.lit(0))
    return t.select(
        F.col("t.id").alias("task_id"),
        key.alias("data_key"),
        F.coalesce("t.data.image", "t.data.audio", "t.data.text").alias("content"),
        F.col("t.data.source").alias("source"),
        F.get(F.get(first["result"], F.lit(0))["value"]["choices"], F.lit(0)).alias("choice"),
        first["score"].alias("score"),
    )


@query(
    "export_shards",
    f"""WITH {_MIXED} SELECT CAST(count(*) AS BIGINT) AS tasks, count(*) FILTER {_KNOWN} AS pre_annotated,
          CAST(ceil(count(*) / 1e3) AS BIGINT) AS shards, CAST(count(*) AS BIGINT) AS listed FROM mixed""",
    ["dirty"],
)
def export_shards(spark, sf):
    """The files of an export, read back: every one must be a whole JSON array."""
    path = new_path(spark, "export")
    classes = ["good", "bad", "click"]
    Q.write_tasks(Q.export_tasks(_mixed(spark, sf), classes), classes, _TASK, path, shard_tasks=1000)
    files = spark.read.schema("value string, shard long").text(f"{path}/tasks", wholetext=True)
    # null unless the file is an array of objects
    parsed = F.from_json("value", "array<struct<id:string,predictions:array<struct<score:double>>>>", {"mode": "FAILFAST"})
    found = files.select(parsed.alias("t")).agg(
        F.sum(F.size("t")).alias("tasks"),
        F.sum(F.size(F.filter("t", lambda t: t["predictions"].isNotNull())).cast("long")).alias("pre_annotated"),
        F.count("t").alias("shards"),
    )
    listed = spark.read.schema("shard long, tasks long, pre_annotated long").json(f"{path}/manifest").agg(F.sum("tasks").alias("listed"))
    return found.withColumn("listed", listed.scalar())


@query(
    "export_summary",
    f"WITH {_MIXED} SELECT count(*) AS total, count(*) FILTER {_KNOWN} AS pre_annotated, count(*) FILTER (NOT {_KNOWN}) AS bare FROM mixed",
    ["dirty"],
)
def export_summary(spark, sf):
    return Q.export_summary(_mixed(spark, sf), ["good", "bad", "click"])


@query(
    "export_project",
    f"SELECT '1.0' AS version, '{STAMP}' AS created_at, '{_TASK}' AS task, 'good,bad' AS classes, count(*) AS total_tasks FROM dirty",
    ["dirty"],
)
def export_project(spark, sf):
    header = Q.export_project(Q.export_tasks(view(spark, sf, "dirty"), CLASSES), CLASSES, _TASK, STAMP)
    return header.withColumn("classes", F.concat_ws(",", "classes"))
