"""Randomised comparisons with plain Python."""

from collections import Counter

import pytest
from conftest import unified
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltworks.operators import audit as A
from siltworks.operators import clean as C
from siltworks.operators import collect as S
from siltworks.operators import quality as Q

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXTS = st.lists(st.one_of(st.none(), st.sampled_from(["", " ", "a", "bb", "a", "ccc" * 9, "\t"])), min_size=1, max_size=25)


@SETTINGS
@given(texts=TEXTS)
def test_duplicates_and_dedupe(spark, texts):
    df = unified(spark, texts)
    assert A.duplicate_count(df).first()["n"] == len(texts) - len(set(texts))
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t, i)
    assert {r["id"] for r in S.dedupe_first(df).collect()} == set(first.values())


@SETTINGS
@given(texts=TEXTS)
def test_balanced_cleaning(spark, texts):
    first = {}
    for i, t in enumerate(texts):
        if t is not None and t.strip():
            first.setdefault(t, i)
    lengths = [len(t) for t in first]
    keep = set(first.values())
    if len(lengths) > 1:
        mean = sum(lengths) / len(lengths)
        std = (sum((x - mean) ** 2 for x in lengths) / (len(lengths) - 1)) ** 0.5
        if std > 0:
            keep = {i for t, i in first.items() if abs(len(t) - mean) / std <= 3}
    assert {r["id"] for r in C.clean(unified(spark, texts), "balanced").collect()} == keep


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from("xyz")), min_size=1, max_size=30))
def test_kappa(spark, pairs):
    a = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pairs)], "id long, label string")
    b = spark.createDataFrame([(i, p[1]) for i, p in enumerate(pairs)], "id long, label string")
    n = len(pairs)
    po = sum(x == y for x, y in pairs) / n
    left, right = Counter(x for x, _ in pairs), Counter(y for _, y in pairs)
    pe = sum(left[c] * right[c] for c in "xyz") / n**2
    got = Q.cohen_kappa(a, b).first()
    assert got["agreement"] == pytest.approx(po, abs=1e-6)
    assert got["kappa"] == pytest.approx(1.0 if pe == 1 else (po - pe) / (1 - pe), abs=1e-6)
