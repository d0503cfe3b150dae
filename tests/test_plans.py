"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from catalog.base import view

MODEL_RUNS = {"train", "predict", "predict_svm", "predict_forest", "save_model", "al_cycle", "al_cycle_embedding", "end_to_end"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_RUNS))
def test_no_cross_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["query_entropy", "query_margin", "query_random", "top_words", "top_sources", "catalog_top", "dedupe_hits"])
def test_top_k_is_not_a_global_sort(spark, sf, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf))


def test_examples_are_limited_before_the_shuffle(spark, sf):
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    df = view(spark, sf, "corpus").select("label", "id")
    ranked = df.withColumn("r", F.row_number().over(W.partitionBy("label").orderBy("id"))).filter("r <= 3")
    assert "WindowGroupLimit" in plan(ranked)


def test_split_tags_rows_without_moving_them(spark, sf):
    text = plan(QUERIES["stratified_split"](spark, sf))
    assert "Window" not in text and "SortMergeJoin" not in text


def test_text_groups_shuffle_hashes_not_texts(spark, sf):
    from siltworks.functions.stats import text_groups

    text = plan(text_groups(view(spark, sf, "dirty")))
    assert re.findall(r"HashAggregate\(keys=\[fp[^\n]*", text) and "SortAggregate" not in text


def test_few_repeated_keys_leave_rows_in_place(spark, sf):
    from siltworks.operators.collect import keep_first
    from siltworks.functions.stats import stored_groups

    df = view(spark, sf, "dirty").select("id", "text")
    groups = stored_groups(df)
    near, far = keep_first(df, groups, "text", "id"), keep_first(df, groups, "text", "id", limit=0)
    assert "Exchange hashpartitioning" not in plan(near).split("Union")[0]
    assert "BroadcastHashJoin" in plan(near) and near.count() == far.count()
    assert {r["id"] for r in near.collect()} == {r["id"] for r in far.collect()}


def test_both_joins_keep_the_same_rows(spark):
    from siltworks.operators.collect import keep_first
    from siltworks.functions.stats import stored_groups

    rows = [(None, "solo"), (1, "a"), (0, "b"), (1, "b"), (None, "a"), (2, None), (None, None), (3, "c"), (3, "c")]
    df = spark.createDataFrame(rows, "id long, text string")
    groups = stored_groups(df)
    sides = [sorted(map(repr, keep_first(df, groups, "text", "id", limit=n).collect())) for n in (0, 100)]
    assert sides[0] == sides[1]
    assert (None, "solo") in [tuple(r) for r in keep_first(df, groups, "text", "id").collect()]
    assert (1, "b") not in [tuple(r) for r in keep_first(df, groups, "text", "id").collect()]


def test_many_repeated_keys_move_only_rows_that_may_repeat(spark):
    """A third of the rows under one text, many texts twice, many once."""
    from siltworks.functions.stats import stored_groups
    from siltworks.operators import collect

    text = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("twice"), (F.col("id") / 6).cast("long"))).otherwise(F.concat(F.lit("once"), "id"))
    df = spark.range(60_000).select("id", text.alias("text"), F.lit(1).alias("n"))
    groups = stored_groups(df)
    near, far = (collect.keep_first(df, groups, "text", "id", limit=n) for n in (10**6, 100))
    assert near.columns == far.columns == df.columns
    assert sorted(r["id"] for r in near.collect()) == sorted(r["id"] for r in far.collect())
    moved = far._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in moved
    # only texts that occur twice, and few others, are shuffled: neither the hot one nor most single ones
    total = groups.agg(F.sum("n")).first()[0]
    cold = groups.filter((F.col("n") > 1) & (F.col("n") * collect.SHARE < total)).select(F.col("fp").alias("_fp"))
    keyed = df.withColumn("_fp", collect.fingerprint(F.col("text")))
    possible = collect.mark_members(keyed, cold, "_fp", cold.count(), "maybe").filter("maybe")
    assert possible.filter("text = 'hot'").count() == 0
    assert 20_000 <= possible.count() < 23_000 and possible.filter("text LIKE 'twice%'").count() == 20_000


def test_membership_stays_bounded_and_loses_nothing(spark):
    from siltworks.functions.membership import mark_members

    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(10_000).select(F.col("id").cast("string").alias("k"), "id").unionByName(spark.createDataFrame([(None, -1)], "k string, id long"))
    for most in (1, 64, 1 << 21):
        marked = mark_members(rows, keys, "k", 5000, "maybe", most)
        assert marked.filter("maybe AND id BETWEEN 0 AND 4999").count() == 5000
        assert marked.filter("k IS NULL AND maybe").count() == 0
    assert marked.filter("maybe AND id >= 5000").count() < 400


def test_spread_join_equals_a_plain_one(spark):
    from siltworks.functions.joins import hot_keys, join_spread

    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 1500)
    rows = spark.range(9000).select("id", key.alias("k"), (F.col("id") % 2).alias("j"))
    keyed = spark.range(0, 1500, 2).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("j"), F.lit("v").alias("v"))
    for how in ("left", "inner"):
        got, want = join_spread(rows, keyed, ["k", "j"], how), rows.join(keyed, ["k", "j"], how)
        assert sorted(map(repr, got.select("id", "k", "j", "v").collect())) == sorted(map(repr, want.select("id", "k", "j", "v").collect()))
    assert {(r["k"], r["j"]) for r in hot_keys(rows, ["k", "j"], 100).collect()} == {(0, 0), (0, 1)}


def test_a_release_leaves_no_folder(spark, tmp_path, monkeypatch):
    from siltworks.functions import scratch

    monkeypatch.setattr(scratch, "shared_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(scratch, "_stored", {})
    scratch.materialize(spark.range(3), "x")
    spark.range(3).write.parquet(scratch.new_path(spark, "y"))
    assert len(list(tmp_path.iterdir())) == 2
    assert scratch.release(spark) == 2 and not list(tmp_path.iterdir())


def test_pooling_hashed_ids(spark):
    from siltworks.operators.collect import combine_sources
    from siltworks.sources.images import image_rows

    paths = spark.createDataFrame([(f"/d/train/{i}.jpg",) for i in range(50)], "path string")
    images = image_rows(paths, "local", collected_at="now")
    texts = images.withColumns({"id": images["id"] * 0 + 7, "text": images["text"]}).limit(1)
    pooled = combine_sources([images, texts, images.limit(0)]).collect()
    assert len(pooled) == 50 and len({r["id"] for r in pooled}) == 50


def test_image_folders_by_any_path(spark, tmp_path, monkeypatch):
    from siltworks.sources.images import scan_image_dir

    for name in ("train/images/a.jpg", "valid/b.png", "other/c.jpg"):
        file = tmp_path / "d" / "img" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x")
    root = f"{tmp_path}/d/img"
    for path in (root, root + "/", f"file://{root}", f"file:{root}", f"{tmp_path}/./d/img", f"{tmp_path}/*/img"):
        assert scan_image_dir(spark, path, "local").count() == 2, path


def test_text_prediction_keeps_rows_with_null_and_repeated_ids(spark):
    from siltworks.operators.features import TermFeatures
    from siltworks.operators.models import predict, train

    features = TermFeatures()
    labeled = spark.createDataFrame([(i, t, t.split()[0]) for i, t in enumerate(["good fine", "bad poor"] * 6)], "id long, text string, label string")
    model = train(features.prepare(labeled), features)
    asked = spark.createDataFrame([(None, "good fine"), (1, "bad poor"), (1, "good fine"), (2, None)], "id long, text string")
    got = [(r["id"], r["text"], r["predicted_label"]) for r in predict(model, asked).collect()]
    assert len(got) == 4
    assert {(None, "good fine", "good"), (1, "bad poor", "bad"), (1, "good fine", "good")} <= set(got)


def test_map_columns_align(spark):
    from siltworks.operators.align import align_by_id

    a = spark.sql("SELECT 1L AS id, map('k', 1) AS m")
    assert align_by_id({"a": a, "b": a}).first()["b_m"] == {"k": 1}


def test_audit_takes_dotted_names(spark):
    from siltworks.operators.audit import missing_by_column

    df = spark.createDataFrame([(1, None), (2, "x")], "id long, `a.b` string")
    assert [r["column"] for r in missing_by_column(df).collect()] == ["a.b"]


def test_rows_nobody_labels_stay_unlabeled(spark):
    from siltworks.operators.annotate import auto_label
    from tests.conftest import unified

    df = unified(spark, ["one", "two"])
    out = auto_label(df, ["x", "y"], {"image": lambda texts, classes: [("x", 1.0)] * len(texts)})
    assert {r["label"] for r in out.collect()} == {"unlabeled"}


def test_filters_and_columns_reach_the_scan(spark, sf):
    from siltworks.operators.annotate import split_unlabeled
    from siltworks.sources.readers import read_examples
    from siltworks.sources.writers import write_examples
    from siltworks.functions.scratch import new_path

    df = read_examples(spark, write_examples(view(spark, sf, "corpus"), new_path(spark, "plan")))
    todo, done = split_unlabeled(df)
    for part in (todo, done):
        text = plan(part.groupBy("source").count())
        assert "EqualNullSafe(label,unlabeled)" in text
        assert "ReadSchema: struct<label:string,source:string>" in text


def test_alignment_uses_one_shuffle(spark, sf):
    text = plan(QUERIES["align_by_id"](spark, sf))
    assert text.count("Exchange hashpartitioning") == 1


def test_dense_prediction_does_not_shuffle(spark, sf):
    assert "Exchange hashpartitioning" not in plan(QUERIES["predict"](spark, sf))
