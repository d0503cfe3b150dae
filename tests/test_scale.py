"""Work that must not grow faster than the input, and its results."""

import pytest
from conftest import unified
from pyspark.sql import functions as F

from siltworks.operators import active as A
from siltworks.operators import features as X
from siltworks.operators import models as M


def test_joined_scores_equal_those_in_the_row(spark):
    labeled = unified(spark, ["good fine day", "bad poor day", "odd thing here"] * 4, ["good", "bad", "odd"] * 4)
    features = X.TermFeatures()
    for df in (labeled, labeled.filter("label <> 'odd'")):
        classifier = M.train(features.prepare(df), features)
        asked = [(None, "good good fine"), (None, "good good fine"), (1, "bad poor"), (1, None), (2, ""), (3, "zzz qqq")]
        prepared = features.prepare(spark.createDataFrame(asked, "id long, text string"))
        order = F.sort_array(F.collect_list(F.struct("id", "probs"))).alias("rows")
        got, want = (f(prepared).agg(order).first()["rows"] for f in (classifier.scores, classifier.probabilities))
        assert [r["id"] for r in got] == [r["id"] for r in want] and len(got) == 6
        for a, b in zip(got, want):
            assert list(a["probs"]) == pytest.approx(list(b["probs"]), abs=1e-12)


def test_cycles_share_the_counted_rows(spark):
    texts = [f"{'good fine' if i % 2 else 'bad poor'} thing{i % 7}" for i in range(60)]
    split = A.stratified_split(unified(spark, texts, ["good" if i % 2 else "bad" for i in range(60)]), seed_size=10)
    parts = [split.filter(F.col("split") == name).drop("split") for name in ("seed", "pool", "test")]
    shared = A.prepare_parts(*parts)
    for strategy in ("entropy", "random"):
        alone, _ = A.al_cycle(*parts, strategy, 2, 5)
        common, _ = A.al_cycle(*parts, strategy, 2, 5, prepared=shared)
        assert alone.collect() == common.collect() and [r["n_labeled"] for r in common.collect()] == [10, 15, 20]


def test_files_and_tasks_follow_the_size_of_the_table(spark, tmp_path):
    from catalog.storage import write_csv, write_examples

    names = {"documents": "doc_id long, text string, source string, lang string, n_chars long", "labels": "doc_id long, quality int, toxic int"}
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.md5(F.concat(F.col("id").cast("string"), i.cast("string")))))
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(9).cast("long").alias("n_chars"))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], names["labels"]).write.parquet(f"{tmp_path}/labels.parquet")
    events = spark.createDataFrame([(1, "{}", "view")], "event_id long, props string, event_type string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        for run, rows in ((write_csv, 20_000), (write_examples, 20_001)):
            out = run(spark, str(tmp_path))
            assert len(out.inputFiles()) > 4 and out.count() == rows
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_vectors_are_measured_on_their_entries(spark, sf):
    from catalog import QUERIES

    out = QUERIES["to_vectors"](spark, sf)
    assert "vector_to_array" not in out._jdf.queryExecution().analyzed().toString().lower()
    assert "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["norm"] for r in out.select("norm").distinct().collect()} == {1.0}


def test_only_what_a_labeler_reads_passes_through_python(spark):
    from siltworks.operators.annotate import auto_label

    rows = [(7, "x" * 3, "unlabeled", "text", "S"), (7, None, "unlabeled", "image", "S"), (None, "yy", "b", "text", "S")]
    df = spark.createDataFrame(rows, "id long, text string, label string, modality string, source string")
    out = auto_label(df, ["a", "b"], {"text": lambda ts: [("b", len(t) / 10) for t in ts], "image": lambda ts: [("a", 1.0)] * len(ts)})
    assert sorted(map(repr, [(r["id"], r["text"], r["label"], r["confidence"], r["source"]) for r in out.collect()])) == sorted(
        map(repr, [(7, "xxx", "b", 0.3, "S"), (7, None, "a", 1.0, "S"), (None, "yy", "b", None, "S")])
    )
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "ArrowEvalPython" in plan


def test_vectors_of_repeated_ids_are_refused(spark):
    weights = spark.createDataFrame([(1, 0, 0.6), (1, 0, 0.8)], "id long, idx int, weight double")
    with pytest.raises(Exception, match="ids must be unique"):
        X.to_vectors(weights, 3)
    assert X.to_vectors(weights.limit(1), 3).count() == 1
