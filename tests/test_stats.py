"""Shared helpers against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.functions import ranks, stats, text
from siltworks.functions.joins import join_small


@pytest.mark.parametrize("kind", ["normal", "heavy", "ties", "two", "third_hot"])
def test_exact_quantiles_beyond_the_bound(spark, kind):
    rng = random.Random(7)
    n = 6000
    values = {
        "normal": [rng.gauss(0, 1) for _ in range(n)],
        "heavy": [rng.paretovariate(0.3) for _ in range(n)],
        "ties": [float(rng.randrange(4)) for _ in range(n)],
        "two": [0.0] * (n - 1) + [1e12],
        "third_hot": [5.0 if i % 3 == 0 else rng.uniform(0, 10) for i in range(n)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = stats.exact_quantiles(df, "x", probs, bound=50, accuracy=200)
    assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
    assert stats.exact_quantiles(df, "x", probs) == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_exact_quantiles_without_values(spark):
    assert stats.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]


@pytest.mark.parametrize("lengths", [[5], [4, 4, 4], [1, 2, 3, 100], [10**6 + i % 2 for i in range(9)], []])
def test_length_profile_matches_numpy(spark, lengths):
    df = spark.createDataFrame([(n, 1) for n in lengths], "len long, n long").groupBy("len").agg(F.sum("n").alias("n"))
    row = stats.length_profile(df).first()
    if not lengths:
        assert row["mean"] is None and row["q1"] is None
        return
    assert row["mean"] == pytest.approx(np.mean(lengths))
    assert row["median"] == pytest.approx(np.median(lengths))
    if len(lengths) == 1:
        assert row["std"] is None
    elif len(set(lengths)) == 1:
        assert row["std"] == 0.0
    else:
        assert row["std"] == pytest.approx(np.std(lengths, ddof=1), rel=1e-9)


def test_hash_rank_is_a_row_number(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 1, None).otherwise("cold"))
    from pyspark.sql import Window as W

    for by in [(), ("g",)]:
        plain = F.row_number().over(W.partitionBy(*by).orderBy(ranks.shuffle_key("id", 42), "id"))
        want = {(r["id"], r["want"]) for r in df.withColumn("want", plain.cast("long")).collect()}
        got = {(r["id"], r["rank"]) for r in ranks.hash_rank(df, by=by, digits=2).collect()}
        assert got == want


def test_running_totals_over_blocks(spark):
    df = spark.range(100).select(F.col("id").alias("batch"), (F.col("id") * 2).alias("n"))
    got = {r["batch"]: r["running_n"] for r in stats.running_totals(df, "batch", ["n"], block=7).collect()}
    assert got == {i: i * (i + 1) for i in range(100)}


def test_term_counts_match_counter(spark):
    from collections import Counter

    rows = [(0, "a b a c ccc bb bb"), (1, ""), (2, "one"), (3, "Été été ÉTÉ x_1 x_1 x")]
    df = spark.createDataFrame(rows, "id long, text string")
    words = df.withColumn("w", text.tokens(F.col("text"))).withColumn("c", text.term_counts(F.col("w")))
    for r in words.collect():
        assert {e["term"]: e["tf"] for e in r["c"]} == dict(Counter(r["w"]))


def test_bigrams(spark):
    got = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>").select(text.bigrams(F.col("w")).alias("b")).collect()
    assert [r["b"] for r in got] == [["a b", "b c"], [], []]


def test_bigrams_are_joined_by_plain_concatenation(spark):
    """``concat_ws`` walks its arguments by iterators, once per pair of words."""
    plan = spark.createDataFrame([(["a", "b"],)], "w array<string>").select(text.bigrams(F.col("w")))._jdf.queryExecution().analyzed().toString()
    assert "concat_ws" not in plan


@pytest.mark.parametrize("limit", [1, 1000])
def test_join_small_gives_the_same_rows_either_way(spark, limit):
    big, small = spark.range(50), spark.range(0, 50, 7)
    assert sorted(r["id"] for r in join_small(big, small, "id", "left_semi", limit).collect()) == list(range(0, 50, 7))


def test_blank_covers_unicode_whitespace(spark):
    texts = ["", " ", "\t\n", " ", " 　", "\x1f", "x", " x ", "​"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(text.is_blank(F.col("t")).alias("b"))
    assert [r["b"] for r in df.collect()] == [not t.strip() for t in texts]


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(stats.percent(F.lit(0), F.lit(0))).first()[0] is None
    assert math.isclose(spark.range(1).select(stats.percent(F.lit(1), F.lit(3))).first()[0], 33.33)


def test_one_heavy_value_among_many(spark):
    values = [5.0] * 400 + [i / 997 for i in range(5000)] + [1e300, -1e300, 5.0 + 1e-15]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.1, 0.5, 0.93, 1.0]
    assert stats.exact_quantiles(df, "x", probs, bound=10, accuracy=64) == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def jobs_of(spark, run):
    """Spark jobs that ``run`` starts."""
    context, name = spark.sparkContext, "counted"
    before = len(context.statusTracker().getJobIdsForGroup(name))
    context.setJobGroup(name, "counted")
    try:
        run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(name)) - before


@pytest.mark.parametrize("bound", [50, 10**6])
def test_quantiles_of_many_columns_share_their_passes(spark, bound):
    rng = random.Random(4)
    n = 3000
    columns = {
        "a": [rng.gauss(0, 1) for _ in range(n)],
        "b.c": [rng.paretovariate(0.5) for _ in range(n)],
        "c": [float(rng.randrange(3)) for _ in range(n)],
        "d": [7.0] * n,
        "e": [rng.uniform(0, 1e-3) if i % 3 else 0.25 for i in range(n)],
        "f": [float(i) for i in range(n)],
    }
    schema = ", ".join(f"`{c}` double" for c in columns) + ", few double, none double, whole int"
    rows = [(*v, float(i) if i < 3 else None, None, i % 11) for i, v in enumerate(zip(*columns.values()))]
    rows += [(*[None] * len(columns), float("nan"), float("nan"), None)] * 5
    df = stats.materialize(spark.createDataFrame(rows, schema), "columns")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    names = [*columns, "few", "none", "whole"]
    found = {}
    many = jobs_of(spark, lambda: found.update(stats.column_quantiles(df, names, probs, bound, accuracy=3000)))
    for c, values in columns.items():
        assert found[c] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
    assert found["few"] == pytest.approx(list(np.quantile([0.0, 1.0, 2.0], probs))) and found["none"] == [None] * len(probs)
    assert found["whole"] == pytest.approx(list(np.quantile([i % 11 for i in range(n)], probs)))
    one = max(jobs_of(spark, lambda c=c: stats.column_quantiles(df, [c], [0.5], bound, accuracy=3000)) for c in ("a", "b.c", "e"))
    assert many <= one + 6  # a few passes more at most, not one set of passes per column and quantile
    assert stats.column_quantiles(df, [], probs) == {}


def test_infinite_values_are_ranked(spark):
    values = [float("-inf")] * 30 + [float(i) for i in range(100)] + [float("inf")] * 30
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = stats.exact_quantiles(df, "x", [0.0, 0.5, 1.0], bound=10, accuracy=64)
    assert got == [float("-inf"), 49.5, float("inf")]
