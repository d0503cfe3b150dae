"""Reader and writer queries: derived tables written out and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import STAMP, query, table, view
from catalog.quality import AUDIT_SQL
from siltworks.functions.scratch import new_path
from siltworks.operators.audit import audit
from siltworks.operators.profile import top_words
from siltworks.schema import REVIEWED
from siltworks.sources import images as I
from siltworks.sources import readers as R
from siltworks.sources import writers as W

_COLS = "id, text, label, modality, source, collected_at"


@query("read_examples", f"SELECT {_COLS} FROM dirty", ["dirty"])
def read_examples(spark, sf):
    path = W.write_examples(view(spark, sf, "dirty"), new_path(spark, "examples"))
    return R.read_examples(spark, path)


@query("write_examples", f"SELECT {_COLS} FROM corpus", ["corpus"])
def write_examples(spark, sf):
    path = W.write_examples(R.spread_even(view(spark, sf, "corpus")), new_path(spark, "examples"))
    return R.read_examples(spark, path)


@query("read_examples_csv", "SELECT id, text, label, source, confidence, corrected_label FROM reviewed", ["reviewed"])
def read_examples_csv(spark, sf):
    queue = view(spark, sf, "reviewed").select("id", "text", "label", "source", "confidence", "corrected_label")
    return R.read_examples_csv(spark, W.write_csv(queue, new_path(spark, "queue")), REVIEWED)


@query("write_csv", f"SELECT {_COLS}, confidence FROM tagged", ["tagged"])
def write_csv(spark, sf):
    return R.read_examples_csv(spark, W.write_csv(R.spread_even(view(spark, sf, "tagged")), new_path(spark, "tagged")))


@query("read_many", f"SELECT {_COLS} FROM corpus UNION ALL SELECT {_COLS} FROM tagged", ["corpus", "tagged"])
def read_many(spark, sf):
    base = new_path(spark, "many")
    W.write_examples(view(spark, sf, "corpus"), f"{base}/corpus_unified.parquet")
    W.write_examples(view(spark, sf, "tagged"), f"{base}/tagged_unified.parquet")
    return R.read_many(spark, f"{base}/*_unified.parquet")


@query("read_history", "SELECT * FROM histories", ["histories"])
def read_history(spark, sf):
    path = new_path(spark, "history")
    # one array document per strategy, as a cycle leaves it: a handful of rounds each
    records = view(spark, sf, "histories").groupBy("strategy").agg(F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("value"))
    records.select("value", "strategy").write.partitionBy("strategy").text(path)
    return R.read_history(spark, f"{path}/*/")


@query("write_report_json", AUDIT_SQL, ["dirty"])
def write_report_json(spark, sf):
    report = audit(view(spark, sf, "dirty"))
    back = spark.read.schema(report.schema).json(W.write_report_json(report, new_path(spark, "report")))
    return back.withColumn("value", F.round("value", 6))


@query("export_dataset", "SELECT doc_id, lang, source, n_chars FROM documents")
def export_dataset(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    path = W.export_dataset(docs, new_path(spark, "export"), "csv")
    return spark.read.schema(docs.schema).option("header", True).option("escape", '"').csv(path)


@query("load_modality", f"SELECT {_COLS} FROM corpus WHERE modality = 'tabular'", ["corpus"])
def load_modality(spark, sf):
    path = W.export_dataset(view(spark, sf, "corpus").filter("modality = 'tabular'").drop("modality"), new_path(spark, "tabular"))
    return R.load_modality(spark, path + "/*.parquet", "tabular").select("id", "text", "label", "modality", "source", "collected_at")


@query(
    "scan_image_dir",
    f"""SELECT path AS text, 'unlabeled' AS label, 'image' AS modality, 'roboflow:a/b' AS source, '{STAMP}' AS collected_at FROM media_paths
        WHERE regexp_matches(path, '\\.(jpg|jpeg|png|bmp|webp)$') AND (contains(path, '/images/') OR contains(path, '/valid/'))""",
    ["media_paths"],
)
def scan_image_dir(spark, sf):
    return I.image_rows(view(spark, sf, "media_paths"), "roboflow:a/b", collected_at=STAMP).drop("id")


@query(
    "image_data_uri",
    """SELECT page_id, path, CASE WHEN path LIKE '%.PNG' THEN 'image/png' WHEN path LIKE '%.webp' THEN 'image/webp' ELSE 'image/jpeg' END AS mime,
              'data:' || CASE WHEN path LIKE '%.PNG' THEN 'image/png' WHEN path LIKE '%.webp' THEN 'image/webp' ELSE 'image/jpeg' END
              || ';base64,' || to_base64(encode(html)) AS data_uri
       FROM media_paths""",
    ["media_paths"],
)
def image_data_uri(spark, sf):
    files = view(spark, sf, "media_paths").select("page_id", "path", F.encode("html", "UTF-8").alias("content"))
    return I.image_data_uri(files).drop("content")


@query(
    "literal_examples",
    r"""SELECT row_number() OVER (ORDER BY n DESC, word) - 1 AS id, word AS text, 'unlabeled' AS label, 'text' AS modality, 'literal' AS source, CAST(NULL AS VARCHAR) AS collected_at
        FROM (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM corpus)
              GROUP BY word ORDER BY n DESC, word LIMIT 20)""",
    ["corpus"],
)
def literal_examples(spark, sf):
    """The twenty most frequent words as literal texts."""
    words = top_words(view(spark, sf, "corpus", spread=True)).collect()
    return R.literal_examples(spark, [r["word"] for r in words])
