"""Audit, cleaning and profiling on hand-written edge tables."""

import pytest
from conftest import unified
from pyspark.sql import functions as F

from siltworks.operators import audit as A
from siltworks.operators import clean as C
from siltworks.operators import collect as S
from siltworks.operators import profile as P

EDGE = [None, None, "", "   ", "\t\n", " ", "abc", "abc", "привет", "😀😀", "x" * 50]


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_null_texts_are_copies_of_each_other(spark):
    assert rows(A.duplicate_count(unified(spark, EDGE))) == [{"n": 2, "pct": 18.18}]


def test_missing_counts(spark):
    assert rows(A.blank_text_count(unified(spark, EDGE))) == [{"n_null": 2, "n_blank": 4, "n_missing": 6}]
    assert {r["column"]: r["n"] for r in rows(A.missing_by_column(unified(spark, EDGE)))} == {"text": 2, "collected_at": 11}


def test_lengths_count_code_points(spark):
    got = {r["id"]: r["len"] for r in rows(A.z_scores(unified(spark, EDGE)))}
    assert got[8] == 6 and got[9] == 2 and got[10] == 50


@pytest.mark.parametrize("texts", [["one"], ["same", "text", "four"], []])
def test_no_outliers_without_deviation(spark, texts):
    df = unified(spark, texts)
    assert rows(A.length_outliers_z(df))[0]["n"] == 0
    assert C.filter_zscore(df).count() == len(texts)
    for strategy in C.STRATEGIES:
        assert C.clean(df, strategy).count() == len(texts)
    assert {r["check"]: r["count"] for r in rows(A.audit(df)) if r["check"] != "length"}["outliers_z"] == 0


def test_imbalance_needs_two_classes(spark):
    for labels in (["a", "a"], ["unlabeled", "unlabeled"], [None, "a"]):
        got = {r["metric"]: r["value"] for r in rows(A.class_imbalance(unified(spark, ["x", "y"], labels))) if r["metric"] != "distribution"}
        assert got["imbalance_ratio"] is None
    got = {r["metric"]: r["value"] for r in rows(A.class_imbalance(unified(spark, ["x"] * 4, [None, "a", "a", "b"])))}
    assert got["imbalance_ratio"] == 2.0 and got["labeled_count"] == 4 and got["null_label_count"] == 1


def test_audit_without_labels(spark):
    got = rows(A.audit(unified(spark, EDGE).select("id", "text")))
    assert {(r["check"], r["column"], r["count"]) for r in got if r["check"] != "length"} == {
        ("duplicates", "text", 2),
        ("outliers_iqr", "text", 3),  # lengths 0, 6 and 50 around the fence 0.5 to 4.5
        ("outliers_z", "text", 0),
        ("missing", "text", 2),
    }


def test_strategies_on_edges(spark):
    df = unified(spark, EDGE, [None] * len(EDGE))
    assert C.clean(df, "conservative").count() == len(EDGE)
    assert {r["label"] for r in rows(C.clean(df, "conservative"))} == {"unknown"}
    kept = rows(C.clean(df, "balanced"))
    assert sorted(r["id"] for r in kept) == [6, 8, 9, 10]
    assert {r["label"] for r in rows(C.clean(df, "balanced", label_fill="unlabeled"))} == {"unlabeled"}
    # distinct lengths 3, 6, 2, 50 put the upper fence at 38.4
    assert sorted(r["id"] for r in rows(C.clean(df, "aggressive"))) == [6, 8, 9]
    with pytest.raises(ValueError):
        C.clean(df, "thorough")


def test_cleaning_is_idempotent_for_copies(spark):
    df = unified(spark, ["a copy"] * 40 + [f"text {i}" for i in range(20)])
    once = C.clean(df, "balanced")
    assert once.count() == 21
    assert rows(A.duplicate_count(once))[0]["n"] == 0
    assert C.clean(once, "balanced").count() == 21


def test_log_agrees_with_the_cleaned_table(spark, sf):
    from catalog.base import view

    df = view(spark, sf, "dirty")
    for strategy in C.STRATEGIES:
        log = sorted(rows(C.cleaning_log(df, strategy)), key=lambda r: r["step"])
        assert log[0]["rows_before"] == df.count()
        assert log[-1]["rows_after"] == C.clean(df, strategy).count()


def test_aggressive_uses_the_fence_of_the_remaining_rows(spark):
    texts = ["a" * 10] * 30 + [chr(98 + i) * (10 + i) for i in range(8)] + ["z" * 400]
    left = {len(r["text"]) for r in rows(C.clean(unified(spark, texts), "aggressive"))}
    assert left == {10, 11, 12, 13, 14, 15, 16, 17}


def test_fix_choices(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, None, 3.0), (4, "b", 1000.0), (5, "c", 2.0)], "id long, text string, v double")
    assert C.fix(df, {"missing": "drop"}).count() == 4
    assert C.fix(df, {"missing": "fill", "duplicates": "drop"}).count() == 4
    assert {r["id"]: r["v"] for r in rows(C.fix(df, {"missing": "median"}))}[2] == 2.5
    clipped = {r["id"]: r["v"] for r in rows(C.fix(df, {"outliers": "clip_iqr"}))}
    assert clipped[2] is None and clipped[4] < 1000
    with pytest.raises(ValueError):
        C.fix(df, {"missing": "guess"})


def test_compare_from_zero_has_no_change(spark):
    got = {r["metric"]: r for r in rows(C.compare_quality(unified(spark, ["a", "b"]), unified(spark, ["a"])))}
    assert got["duplicates"]["change_pct"] is None
    assert got["rows"]["change_pct"] == -50.0


def test_hot_text_is_counted_whole(spark):
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "boilerplate").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"),
    )
    assert rows(A.duplicate_count(df))[0]["n"] == 999
    assert S.dedupe_first(df).count() == 2001


def test_histogram_of_one_value(spark):
    got = rows(P.histogram_bins(spark.range(5).select(F.lit(2.0).alias("x")), "x", 4))
    assert [r["n"] for r in sorted(got, key=lambda r: r["bin"])] == [0, 0, 5, 0]


def test_combine_keeps_the_first_source(spark):
    a, b = unified(spark, ["x", "y"], ["la", "la"]), unified(spark, ["y", "z"], ["lb", "lb"])
    got = {(r["text"], r["label"]) for r in rows(S.combine_sources([a, b]))}
    assert got == {("x", "la"), ("y", "la"), ("z", "lb")}
    assert len({r["id"] for r in rows(S.combine_sources([a, b]))}) == 3


def test_unify_drops_null_and_blank(spark):
    df = spark.createDataFrame([(1, None, 3), (2, " ", 4), (3, "ok", None)], "id long, body string, mark int")
    got = rows(S.unify(df, "body", "mark", source="hf:x", collected_at="now"))
    assert got == [{"id": 3, "text": "ok", "label": "unlabeled", "modality": "text", "source": "hf:x", "collected_at": "now"}]
    with pytest.raises(ValueError):
        S.unify(df, "body", modality="video")


def test_catalog_defaults(spark):
    df = spark.createDataFrame(
        [("a", [], None, None, 1500000), ("b", ["modality:audio", "task_categories:x", "task_categories:y"], 5, 1, None)],
        "id string, tags array<string>, downloads long, likes long, bytes long",
    )
    got = {r["id"]: r for r in rows(S.catalog_top(S.catalog_tags(df), "downloads", 2))}
    assert (got["a"]["size"], got["a"]["task"], got["a"]["modality"], got["a"]["downloads"], got["a"]["size_mb"]) == ("?", "?", "text", 0, 1.5)
    assert (got["b"]["task"], got["b"]["modality"]) == ("x", "audio")


def test_url_helpers(spark):
    urls = ["https://www.KAGGLE.com/d", "http://archive.uci.edu/x", "https://universe.roboflow.com/ws/proj?x=1", "ftp://none"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r["site"] for r in S.classify_host(df).collect()] == ["Kaggle", "UCI", "Web", "Web"]
    got = S.parse_project_url(df, "url", r"https?://universe\.roboflow\.com/([^/]+)/([^/?#]+)").collect()
    assert [(r["workspace"], r["project"]) for r in got] == [(None, None), (None, None), ("ws", "proj"), (None, None)]


def test_visible_text(spark):
    html = "<html><script>a<b</script><style>p{}</style><!-- x>y --><p>One&nbsp;&amp;\n two</p></html>"
    assert spark.range(1).select(S.visible_text(F.lit(html))).first()[0] == "One & two"
