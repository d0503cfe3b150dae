"""Alignment by id and by time."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltworks.operators import align as L

T0 = datetime(2024, 1, 1)


def frame(spark, rows, kind):
    df = spark.createDataFrame([(i, k, T0 + timedelta(seconds=s)) for i, k, s in rows], "id long, k string, ts timestamp")
    return df.withColumn("ts", F.col("ts").cast(kind))


def brute(left, right):
    best = {}
    for i, k, s in left:
        hits = [(rs, ri) for ri, rk, rs in right if rk == k and k is not None and rs <= s]
        best[i] = max(hits)[1] if hits else None
    return best


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("levels", [(), (60,), (60, 86_400), (1, 10, 100)])
def test_asof_matches_brute_force(spark, kind, levels):
    rng = random.Random(5)
    keys = ["hot"] * 6 + ["a", "b", None]
    left = [(i, rng.choice(keys), rng.choice([rng.uniform(0, 400_000), rng.randrange(0, 600, 30)])) for i in range(200)]
    right = [(1000 + i, rng.choice(keys), rng.choice([rng.uniform(0, 400_000), rng.randrange(0, 600, 30)])) for i in range(120)]
    left = [(i, k, round(s, 3)) for i, k, s in left]
    right = [(i, k, round(s, 3)) for i, k, s in right]
    out = L.align_asof(frame(spark, left, kind), frame(spark, right, kind), "k", "ts", levels=levels)
    got = {r["id"]: r["right_id"] for r in out.collect()}
    assert len(got) == len(left) and got == brute(left, right)


def test_asof_tolerance_and_ties(spark):
    left = [(1, "a", 10), (2, "a", 100), (3, "z", 5)]
    right = [(7, "a", 10), (8, "a", 10), (9, "a", 11)]
    out = L.align_asof(frame(spark, left, "timestamp"), frame(spark, right, "timestamp"), "k", "ts", 30)
    got = {r["id"]: (r["right_id"], r["right_ts"]) for r in out.collect()}
    assert got == {1: (8, T0 + timedelta(seconds=10)), 2: (None, None), 3: (None, None)}


def three(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "id long, v string")
    b = spark.createDataFrame([(2, 20), (3, 30)], "id long, w int")
    c = spark.createDataFrame([(3, True), (None, False)], "id long, f boolean")
    return {"text": a, "image": b, "audio": c}


def test_alignment_loses_nothing(spark):
    aligned = L.align_by_id(three(spark))
    rows = {r["id"]: r for r in aligned.filter("id IS NOT NULL").collect()}
    assert set(rows) == {1, 2, 3} and aligned.count() == 5
    assert (rows[2]["text_v"], rows[2]["image_w"], rows[2]["has_audio"]) == ("y", 20, False)
    assert rows[1]["image_w"] is None and rows[3]["audio_f"] is True
    cover = {r["modalities"]: r["n"] for r in L.alignment_coverage(aligned, ["text", "image", "audio"]).collect()}
    assert cover == {"text": 3, "image": 2, "audio": 2, "text+image": 1, "text+audio": 0, "image+audio": 1, "text+image+audio": 0}
    assert {(r["pair"], r["id"]) for r in L.pair_examples(aligned, ["text", "image", "audio"]).collect()} == {("text+image", 2), ("image+audio", 3)}


def test_repeated_keys_raise_until_resolved(spark):
    tables = three(spark)
    tables["text"] = tables["text"].unionByName(spark.createDataFrame([(2, "again")], "id long, v string"))
    with pytest.raises(Exception, match="several rows of text for key 2"):
        L.align_by_id(tables).collect()
    tables["text"] = L.one_per_key(tables["text"].filter("id IS NOT NULL"), "id", "v")
    assert {r["id"]: r["text_v"] for r in L.align_by_id(tables).filter("has_text").collect()} == {1: "x", 2: "again"}
