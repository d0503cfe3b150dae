"""Labeling, replies, review and agreement on hand-written edge tables."""

import json

import pytest
from conftest import unified
from pyspark.sql import functions as F

from siltworks.operators import annotate as N
from siltworks.operators import quality as Q
from siltworks.operators import review as V
from siltworks.operators.labelsink import LabelSink
from siltworks.schema import LABELED, REVIEWED

CLASSES = ["pos", "neg"]


def parsed(spark, reply, n=2, strict=True):
    items = [(i + 1, 100 + i, f"t{i}") for i in range(n)]
    df = spark.createDataFrame([(0, items, reply)], "batch long, items array<struct<pos:int,id:long,text:string>>, reply string")
    return [(r["label"], r["confidence"]) for r in sorted(N.parse_label_replies(df, CLASSES, strict=strict).collect(), key=lambda r: r["pos"])]


@pytest.mark.parametrize(
    "reply, want",
    [
        ('[{"label":"neg","confidence":0.9},{"label":"pos","confidence":0.1}]', [("neg", 0.9), ("pos", 0.1)]),
        ('Here you are:\n[{"label":"neg","confidence":0.9},{"label":"pos"}]\nbye', [("neg", 0.9), ("pos", 0.5)]),
        ('[{"label":"other","confidence":"0.25"},{"confidence":7}]', [("pos", 0.25), ("pos", 1.0)]),
        ('[{"label":"neg","confidence":-3},{"label":"neg","confidence":"high"}]', [("pos", 0.0), ("pos", 0.0)]),
        ('[{"label":"neg","confidence":null},{"label":"neg","confidence":1}]', [("pos", 0.0), ("pos", 0.0)]),
        ('[{"label":"neg","confidence":0.9}]', [("neg", 0.9), ("pos", 0.0)]),
        ('[{"label":"neg"},{"label":"neg"},{"label":"neg"}]', [("neg", 0.5), ("neg", 0.5)]),
        ("no json at all", [("pos", 0.0), ("pos", 0.0)]),
        ('[{"label":"neg","confidence":0.9},{"label":', [("pos", 0.0), ("pos", 0.0)]),
        ('[{"label":"neg","confidence":0.9},{"label":"pos" oops}]', [("pos", 0.0), ("pos", 0.0)]),
        ("[1, 2]", [("pos", 0.0), ("pos", 0.0)]),
        ("", [("pos", 0.0), ("pos", 0.0)]),
        (None, [("pos", 0.0), ("pos", 0.0)]),
    ],
)
def test_replies(spark, reply, want):
    assert parsed(spark, reply) == want


def test_lenient_replies_keep_the_good_items(spark):
    reply = '[{"label":"neg","confidence":0.9},{"label":"neg","confidence":"high"}]'
    assert parsed(spark, reply, strict=False) == [("neg", 0.9), ("neg", 0.5)]


@pytest.mark.parametrize("most, shown", [(None, 400), (300, 300)])
def test_batches_are_full_and_show_whole_texts_or_beginnings(spark, most, shown):
    df = unified(spark, ["x" * 400] * 23)
    batches = N.label_batches(df, CLASSES, "task", max_chars=most).collect()
    assert sorted(len(b["items"]) for b in batches) == [3, 10, 10]
    assert all(len(i["text"]) == shown for b in batches for i in b["items"])
    assert sorted(i["id"] for b in batches for i in b["items"]) == list(range(23))
    assert "10. x" in next(b for b in batches if len(b["items"]) == 10)["prompt"]


def test_split_is_exhaustive(spark):
    df = unified(spark, ["a"] * 4, ["unlabeled", None, "pos", "unlabeled"])
    todo, done = N.split_unlabeled(df)
    assert (todo.count(), done.count()) == (2, 2)
    todo, done = N.split_unlabeled(df.drop("label"))
    assert (todo.count(), done.count()) == (4, 0)


def test_dominant_modality(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "modality string")
    assert N.dominant_modality(df).first()[0] == "a"
    assert N.dominant_modality(df, "image").first()[0] == "image"
    assert N.dominant_modality(df.limit(0)).first()[0] == "text"


def test_labeler_failures_and_bad_answers(spark):
    def labeler(texts):
        if "boom" in texts:
            raise RuntimeError("refused")
        return [("neg" if t == "n" else "weird", 3.0) for t in texts]

    df = unified(spark, ["n", "p", "kept"], ["unlabeled", "unlabeled", "gold"]).coalesce(1)
    got = {r["id"]: (r["label"], r["confidence"]) for r in N.auto_label(df, CLASSES, labeler).collect()}
    assert got == {0: ("neg", 1.0), 1: ("pos", 1.0), 2: ("gold", None)}
    got = {r["label"]: r["confidence"] for r in N.auto_label(unified(spark, ["boom", "n"]).coalesce(1), CLASSES, labeler).collect()}
    assert got == {"pos": 0.0}
    with pytest.raises(ValueError):
        N.auto_label(df, CLASSES)


def test_labeler_by_modality_gets_single_calls(spark):
    def images(paths):
        assert len(paths) == 1
        return [("neg", 0.9)]

    def texts(batch):
        return [("pos", len(batch) / 10)] * len(batch)

    df = unified(spark, [f"f{i}" for i in range(14)]).coalesce(1).withColumn("modality", F.when(F.col("id") < 3, "image").when(F.col("id") == 3, "other").otherwise("text"))
    got = {r["id"]: (r["label"], r["confidence"]) for r in N.auto_label(df, CLASSES, {"text": texts, "image": images}).collect()}
    assert [got[i] for i in range(3)] == [("neg", 0.9)] * 3
    assert got[3] == ("pos", 1.0) and got[13] == ("pos", 0.1)


def test_resume_finishes_exactly_once(spark):
    todo = unified(spark, [f"t{i}" for i in range(10)])
    done = todo.filter("id < 4")
    rest = N.resume_labeling(todo, done)
    assert sorted(r["id"] for r in done.unionByName(rest).collect()) == list(range(10))


def queue(spark, rows):
    return spark.createDataFrame([(i, f"t{i}", a, "text", "s", None, 0.5, b) for i, (a, b) in enumerate(rows)], REVIEWED)


def test_pending_rules(spark):
    df = queue(spark, [("a", None), ("a", ""), ("a", "a"), ("a", "b"), (None, "b")])
    assert sorted(r["id"] for r in V.pending_review(df).collect()) == [0, 1, 2]
    assert V.review_progress(df).first().asDict() == {"total": 5, "done": 2, "remaining": 3}
    got = V.review_stats(df).first().asDict()
    assert (got["corrected"], got["error_pct"], got["accuracy_pct"], got["high_error"]) == (2, 40.0, 60.0, True)


def test_review_stats_of_an_empty_queue(spark):
    assert V.review_stats(queue(spark, [])).first().asDict() == {"in_queue": 0, "corrected": 0, "error_pct": 0.0, "accuracy_pct": 100.0, "high_error": False}


def test_merge_prefers_reviewed_and_later_rows(spark):
    labeled = spark.createDataFrame(
        [(1, "x", "a", "text", "s", None, 0.9), (2, "x", "b", "text", "s", None, 0.8), (3, "y", "a", "text", "s", None, 0.2), (4, "z", "g", "text", "s", None, None)], LABELED
    )
    reviewed = V.review_queue(labeled).withColumn("corrected_label", F.lit("c"))
    assert {(r["id"], r["label"]) for r in V.apply_review(labeled, reviewed).collect()} == {(2, "b"), (3, "c"), (4, "g")}
    assert {r["id"] for r in V.apply_review(labeled, reviewed, strict_reference=True).collect()} == {2, 3}
    again = reviewed.withColumn("text", F.lit("x")).withColumn("corrected_label", F.lit(""))
    assert {(r["id"], r["label"]) for r in V.apply_review(labeled, again).collect()} == {(3, "a"), (4, "g")}


def test_kappa_extremes(spark):
    def frame(labels):
        return spark.createDataFrame(list(enumerate(labels)), "id long, label string")

    a = frame(["x", "y", "x", "y"])
    assert Q.cohen_kappa(a, a).first().asDict() == {"n": 4, "agreement": 1.0, "kappa": 1.0}
    assert Q.cohen_kappa(a, frame(["y", "x", "y", "x"])).first()["kappa"] == -1.0
    one = frame(["x", "x"])
    assert Q.cohen_kappa(one, one).first()["kappa"] == 1.0
    assert Q.cohen_kappa(a, a.limit(0)).first()["kappa"] is None


def test_label_quality_without_confidence(spark):
    got = {r["metric"]: r["value"] for r in Q.label_quality(unified(spark, ["a"] * 3, ["p", "unlabeled", None])).collect() if r["label"] is None}
    assert got == {"total": 3.0, "labeled": 2.0, "unlabeled": 1.0, "imbalance_ratio": None, "imbalance_high": 0.0}


def test_exported_task_shape(spark):
    rows = [
        (1, "path.png", "pos", "image", "s", None, None),
        (2, "t", "unlabeled", "text", None, None, 0.4),
        (3, '{"k": 1}', "neg", "tabular", "s", None, float("nan")),
        (4, None, None, "audio", "s", None, 0.1),
    ]
    out = {r["data_key"] + str(i): json.loads(r["task_json"]) for i, r in enumerate(Q.export_tasks(spark.createDataFrame(rows, LABELED).coalesce(1), CLASSES).collect())}
    image, text, table, audio = out["image0"], out["text1"], out["text2"], out["audio3"]
    assert image["data"] == {"image": "path.png", "source": "s"}
    assert image["predictions"][0]["score"] == 1.0
    result = image["predictions"][0]["result"][0]
    assert (result["value"], result["from_name"], result["to_name"], result["type"]) == ({"choices": ["pos"]}, "label", "image", "choices")
    assert "predictions" not in text and text["data"] == {"text": "t", "source": ""}
    assert table["predictions"][0]["score"] == 1.0
    assert "predictions" not in audio and audio["data"] == {"audio": "", "source": "s"}
    assert len({t["id"] for t in out.values()}) == 4


def test_keyword_scores(spark):
    df = unified(spark, ["good good bad", "nothing", None])
    got = [tuple(r) for r in N.auto_label(df, ["good", "bad"], rules={"good": "good", "bad": "bad"}).orderBy("id").select("label", F.round("confidence", 3)).collect()]
    assert got == [("good", 0.667), ("good", 0.0), ("good", 0.0)]


# ---- labels written batch by batch


def counting_labeler(folder, broken_after=None):
    """Notes every text it gets in a file of its own; may die after some calls."""

    def labeler(texts):
        import os
        import uuid

        if broken_after is not None and len(os.listdir(folder)) >= broken_after:
            os._exit(1)  # the worker is lost, not just the call
        for t in texts:
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(t)
        return [("pos" if t.endswith(("0", "2", "4")) else "neg", 0.5) for t in texts]

    return labeler


def calls(folder):
    return sorted(p.read_text() for p in folder.iterdir())


def test_a_labeling_run_goes_on_where_it_ended(spark, tmp_path):
    (seen := tmp_path / "calls").mkdir()
    rows = [(i, f"t{i}", "unlabeled" if i % 5 else "gold", 1) for i in range(60)] + [(None, "no id", "unlabeled", 1)] * 2
    df = spark.createDataFrame(rows, "id long, text string, label string, n int")
    labeler = counting_labeler(str(seen))
    assert LabelSink(spark, f"{tmp_path}/sink").append(df, CLASSES, labeler, batch_rows=10, most_batches=2) == 2
    assert 0 < len(calls(seen)) < 50
    assert LabelSink(spark, f"{tmp_path}/sink").append(df, CLASSES, labeler, batch_rows=10) == 3
    assert LabelSink(spark, f"{tmp_path}/sink").append(df, CLASSES, labeler, batch_rows=10) == 0
    assert calls(seen) == sorted(r[1] for r in rows if r[2] == "unlabeled")  # every row once
    got = LabelSink(spark, f"{tmp_path}/sink").table(df)
    want = N.auto_label(df, CLASSES, counting_labeler(str(seen)))
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_a_batch_that_dies_half_way_is_written_again(spark, tmp_path):
    (seen := tmp_path / "calls").mkdir()
    df = unified(spark, [f"t{i}" for i in range(30)])
    sink = LabelSink(spark, f"{tmp_path}/sink")
    with pytest.raises(Exception):
        sink.append(df, CLASSES, counting_labeler(str(seen), broken_after=14), batch_rows=8)
    finished = sink._log("batch")
    kept = {r["id"] for r in sink.labels(N.auto_label(df, CLASSES, rules={"pos": "a", "neg": "b"}).schema).collect()}
    assert len(finished) < 4
    # rows that come later make batches of their own, those whose batch was lost are labeled anew
    more = df.unionByName(unified(spark, [f"t{i}" for i in range(30, 35)]).withColumn("id", F.col("id") + 30))
    sink.append(more, CLASSES, counting_labeler(str(seen)), batch_rows=8)
    got = sink.table(more).collect()
    assert sorted(r["id"] for r in got) == list(range(35)) and all(r["confidence"] == 0.5 for r in got)
    again = [t for t in set(calls(seen)) if calls(seen).count(t) > 1]
    assert not {int(t[1:]) for t in again} & kept


def test_sink_of_nothing(spark, tmp_path):
    df = unified(spark, ["a"], ["gold"])
    sink = LabelSink(spark, f"{tmp_path}/sink")
    assert sink.append(df, CLASSES, rules={"pos": "a", "neg": "b"}) == 0
    assert [r["label"] for r in sink.table(df).collect()] == ["gold"]


def test_export_files_are_whole_arrays(spark, tmp_path):
    rows = [(i, f'text "{i}"\n<é>', CLASSES[i % 2] if i % 3 else "unlabeled", "text", "s", None, 0.5) for i in range(25)]
    df = spark.createDataFrame(rows, LABELED).repartition(4)
    path = Q.write_tasks(Q.export_tasks(df, CLASSES), CLASSES, "t", f"{tmp_path}/x", shard_tasks=10)
    shards = sorted((tmp_path / "x" / "tasks").glob("shard=*"))
    arrays = [json.loads(f.read_text()) for s in shards for f in s.glob("part-*")]
    assert [len(a) for a in arrays] == [10, 10, 5]
    assert sorted(t["data"]["text"] for a in arrays for t in a) == sorted(r[1] for r in rows)
    manifest = spark.read.json(f"{path}/manifest").collect()
    summary = Q.export_summary(df, CLASSES).first()
    assert sum(r["tasks"] for r in manifest) == summary["total"] and sum(r["pre_annotated"] for r in manifest) == summary["pre_annotated"]
    Q.write_tasks(Q.export_tasks(df.limit(0), CLASSES), CLASSES, "t", f"{tmp_path}/none")
    assert spark.read.json(f"{tmp_path}/none/project").first()["total_tasks"] == 0
