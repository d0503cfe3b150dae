"""Readers and writers."""

import base64
import json
import re

import pytest
from conftest import unified
from pyspark.sql import functions as F

from siltworks.functions import scratch
from siltworks.schema import HISTORY, REVIEWED, UNIFIED
from siltworks.sources import images as I
from siltworks.sources import readers as R
from siltworks.sources import writers as W


def test_csv_with_bom_quotes_and_newlines(spark, tmp_path):
    path = tmp_path / "queue.csv"
    path.write_text('text,label,source,confidence,corrected_label\n"a ""b""\nc, d","pos","hf:x",0.62,"pos"\n"e","neg","scrape:y",0.58,""\n', encoding="utf-8-sig")
    got = [r.asDict() for r in R.read_examples_csv(spark, str(path)).collect()]
    assert got[0] == {"text": 'a "b"\nc, d', "label": "pos", "source": "hf:x", "confidence": 0.62, "corrected_label": "pos"}
    assert got[1]["corrected_label"] == ""


def test_csv_round_trip(spark, tmp_path):
    texts = ['quote " inside', "line\nbreak", " padded ", "", None, "comma, here", "back\\slash", 'ends with "', "é\U0001f600"]
    df = unified(spark, texts)
    W.write_csv(df, str(tmp_path / "out"))
    got = {r["id"]: r["text"] for r in R.read_examples_csv(spark, str(tmp_path / "out")).collect()}
    assert got == dict(enumerate(texts))


def test_history_strategy_from_file_name(spark, tmp_path):
    record = {"iteration": 0, "n_labeled": 50, "accuracy": 0.5, "f1": 0.4}
    for name, extra in (("entropy", {}), ("margin", {"strategy": "margin"})):
        (tmp_path / f"history_{name}.json").write_text(json.dumps([{**record, **extra}, {**record, **extra, "iteration": 1}], indent=2))
    got = R.read_history(spark, str(tmp_path / "history_*.json"))
    assert sorted((r["strategy"], r["iteration"]) for r in got.collect()) == [("entropy", 0), ("entropy", 1), ("margin", 0), ("margin", 1)]
    assert got.schema.fieldNames() == HISTORY.fieldNames()


def test_read_examples_fills_missing_columns(spark, tmp_path):
    unified(spark, ["a"]).drop("label").write.parquet(str(tmp_path / "p"))
    assert R.read_examples(spark, str(tmp_path / "p")).first()["label"] is None


def test_literal_examples(spark):
    assert [r["text"] for r in R.literal_examples(spark, ["a", "b"]).orderBy("id").collect()] == ["a", "b"]


@pytest.fixture()
def image_dir(tmp_path):
    for name in ("train/images/a.jpg", "train/images/B.JPG", "train/skipped.png", "valid/c.png", "valid/d.txt", "test/images/e.webp", "test/images/deep/f.png", "other/g.jpg"):
        path = tmp_path / "set" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"bytes of " + name.encode())
    return tmp_path / "set"


def test_image_folder(spark, image_dir):
    got = I.scan_image_dir(spark, str(image_dir), "roboflow:w/p", "now").collect()
    assert sorted(r["text"] for r in got) == sorted(str(image_dir / n) for n in ("train/images/a.jpg", "valid/c.png", "test/images/e.webp"))
    assert {(r["label"], r["modality"], r["source"], r["collected_at"]) for r in got} == {("unlabeled", "image", "roboflow:w/p", "now")}
    assert sorted(r["text"] for r in R.load_modality(spark, str(image_dir), "image").collect()) == sorted(r["text"] for r in got)


def test_image_folder_scan_reads_paths_only(spark, image_dir):
    plan = I.scan_image_dir(spark, str(image_dir), "x", "now")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_data_uri(spark, image_dir):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(image_dir))
    for r in I.image_data_uri(files).collect():
        mime, body = r["data_uri"].split(";base64,")
        assert base64.b64decode(body) == bytes(r["content"])
        assert mime == "data:" + {"png": "image/png", "webp": "image/webp"}.get(r["path"].rsplit(".", 1)[1], "image/jpeg")


def test_audio_folder(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"x")
    (tmp_path / "b.txt").write_bytes(b"x")
    got = R.load_modality(spark, str(tmp_path), "audio", "local:calls").collect()
    assert [(r["text"], r["modality"], r["source"]) for r in got] == [(str(tmp_path / "a.wav"), "audio", "local:calls")]


def test_export_formats(spark, tmp_path):
    df = unified(spark, ["a", "b"])
    for kind in ("csv", "parquet", "json"):
        assert spark.read.format(kind).option("header", True).load(W.export_dataset(df, str(tmp_path / kind), kind)).count() == 2
    with pytest.raises(ValueError):
        W.export_dataset(df, str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError):
        R.load_modality(spark, "x", "video")


def test_read_many_globs(spark, tmp_path):
    W.write_examples(unified(spark, ["a"]), str(tmp_path / "x_unified.parquet"))
    W.write_examples(unified(spark, ["b"]).drop("source"), str(tmp_path / "y_unified.parquet"))
    W.write_examples(unified(spark, ["c"]), str(tmp_path / "z.parquet"))
    got = R.read_many(spark, str(tmp_path / "*_unified.parquet"))
    assert sorted(r["text"] for r in got.collect()) == ["a", "b"] and got.schema.fieldNames() == UNIFIED.fieldNames()
    assert R.read_many(spark, str(tmp_path / "*_unified.parquet"), schema=None).count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert scratch.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_small_single_file_is_spread(spark, tmp_path):
    path = W.write_examples(unified(spark, ["a"] * 50).coalesce(1), str(tmp_path / "one"))
    df = R.read_examples(spark, path)
    assert "RoundRobin" in R.spread_small(df, path)._jdf.queryExecution().executedPlan().toString()
    assert R.spread_small(df, path, max_bytes=1) is df


def test_reviewed_schema_keeps_order(spark):
    assert REVIEWED.fieldNames()[-2:] == ["confidence", "corrected_label"]


def test_release_removes_only_stored_tables(spark, tmp_path):
    kept = W.write_examples(unified(spark, ["a"]), str(tmp_path / "kept"))
    stored = scratch.materialize(unified(spark, ["b"]), "gone")
    path = stored.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    assert scratch.release(spark) >= 1
    import os

    assert not os.path.exists(path) and os.path.exists(kept)


def test_markup_against_the_standard_library(spark):
    import html as plain
    from html.entities import html5

    from siltworks.functions.markup import references, visible_text

    pieces = ["&eacute;", "&#x20AC;", "&#8364;", "&#128;", "&#x80;", "&amp;lt;", "&&amp;;", "&unknown;", "&#xD800;", "&#1114112;", "&#0;", "&NotEqualTilde;",
              "& x", "&", "a&b;c", "&#;", "&#x;", "&CounterClockwiseContourIntegral;", "&Amp;", "&#120120;", "&lt;b&gt;", "plain"]
    rows = [(p,) for p in pieces] + [("".join(pieces),), (None,), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "h string").coalesce(1).select(visible_text(F.col("h"))).collect()]

    def want(text):
        if text is None:
            return None
        known = re.sub(r"&(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]*);", lambda m: plain.unescape(m[0]) if m[1][0] == "#" or m[1] + ";" in html5 else m[0], text)
        return re.sub(r"[ \t\n\x0b\f\r]+", " ", known).strip(" ")

    assert got == [want(r[0]) for r in rows]
    assert len(references()) > 20_000


@pytest.mark.parametrize(
    "html, text",
    [
        ('<a title="x > y">link</a>', "link"),
        ("<a title='1 > \"2\"' href=\"b>c\">link</a> rest", "link rest"),
        ('<p title="open>one</p> two', "one two"),
        ("<script>if (a > b) '<p>'</script>kept<!-- <p title=\"x\"> -->", "kept"),
        ("a<br/>b<hr >c", "a b c"),
        ("<p " + "x='" + ">" * 50_000 + "'>long</p>" + "<i a=\"b\">y</i>" * 3000, "long" + " y" * 3000),
        ("<" * 20_000, "<" * 20_000),
    ],
)
def test_tags_with_quoted_attributes(spark, html, text):
    from siltworks.functions.markup import visible_text

    assert spark.createDataFrame([(html,)], "h string").select(visible_text(F.col("h"))).first()[0] == text
