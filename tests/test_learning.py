"""Features, split, query strategies, models, the cycle and its savings."""

import math

import numpy as np
import pytest
from conftest import unified
from pyspark.sql import functions as F

from siltworks.operators import active as A
from siltworks.operators import features as X
from siltworks.operators import models as M
from siltworks.schema import HISTORY

GOOD = ["sunny bright lovely day", "lovely bright morning sun", "sunny lovely garden day", "bright happy morning"]
BAD = ["dark cold rainy night", "rainy cold storm wind", "dark storm cold night", "gloomy rainy wind"]


def corpus(spark, copies=12):
    texts, labels = [], []
    for i in range(copies):
        for t, label in [(t, "good") for t in GOOD] + [(t, "bad") for t in BAD]:
            texts.append(f"{t} extra{i}")
            labels.append(label)
    return unified(spark, texts, labels)


def parts(df):
    return [df.filter(F.col("split") == name).drop("split") for name in ("seed", "pool", "test")]


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(0, "aa bb aa"), (1, "bb cc"), (2, "")], "id long, text string")
    vocab = X.tfidf_vocabulary(df)
    assert {r["term"]: (r["tf"], r["df"]) for r in vocab.collect()} == {"aa": (2, 1), "bb": (2, 2), "cc": (1, 1), "aa bb": (1, 1), "bb aa": (1, 1), "bb cc": (1, 1)}
    assert [r["term"] for r in vocab.orderBy("idx").collect()] == sorted(["aa", "bb", "cc", "aa bb", "bb aa", "bb cc"])
    idf = {t: math.log(4 / (1 + d)) + 1 for t, d in {"aa": 1, "bb": 2, "aa bb": 1, "bb aa": 1}.items()}
    raw = {"aa": (1 + math.log(2)) * idf["aa"], "bb": idf["bb"], "aa bb": idf["aa bb"], "bb aa": idf["bb aa"]}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    got = {r["term"]: r["weight"] for r in X.tfidf_weights(df, vocab, 3).filter("id = 0").collect()}
    assert got == pytest.approx({t: v / norm for t, v in raw.items()})


def test_vocabulary_limit_breaks_ties_by_term(spark):
    df = spark.createDataFrame([(0, "dd cc bb aa"), (1, "dd")], "id long, text string")
    top = [r["term"] for r in X.tfidf_vocabulary(df, 3).orderBy(F.desc("tf"), "term").collect()]
    assert top == ["dd", "aa", "bb"]


def test_scaling_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0]), (1, [3.0, 5.0])], "id long, v array<double>")
    got = {r["id"]: r["scaled"] for r in X.standard_scale(df, "v").collect()}
    assert got == {0: [-1.0, 0.0], 1: [1.0, 0.0]}


def test_tabular_defects_become_zero(spark):
    texts = ['{"b": 2, "a": 1}', '{"a": "3"}', '{"a": {"x": 1}, "b": true}', "not json", None, '{"a": 1e2, "b": null}']
    df = unified(spark, texts)
    assert X.json_keys(df) == ["a", "b"]
    got = {r["id"]: r["vector"] for r in X.json_numbers(df, ["a", "b"]).collect()}
    assert got == {0: [1.0, 2.0], 1: [3.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0], 5: [100.0, 0.0]}
    with pytest.raises(ValueError):
        X.json_keys(df, limit=1)


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "rare").when(F.col("id") % 7 == 1, "unlabeled").otherwise("hot").alias("label"))
    split = A.stratified_split(df)
    rows = {r["id"]: (r["label"], r["split"]) for r in split.collect()}
    labeled = df.filter("label <> 'unlabeled'").count()
    assert len(rows) == labeled
    sizes = {name: sum(1 for v in rows.values() if v[1] == name) for name in ("test", "seed", "pool")}
    assert sizes["test"] == math.ceil(0.2 * labeled) and sizes["seed"] == 50 and sum(sizes.values()) == labeled
    n_rare = sum(1 for v in rows.values() if v[0] == "rare")
    assert abs(sum(1 for v in rows.values() if v == ("rare", "test")) - 0.2 * n_rare) <= 1
    assert {r["id"]: (r["label"], r["split"]) for r in A.stratified_split(df.repartition(5)).collect()} == rows


def test_split_of_few_rows(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(6)], "id long, label string")
    got = [r["split"] for r in A.stratified_split(df).collect()]
    assert got.count("test") == 2 and got.count("seed") == 4


def test_query_ties_go_to_the_smallest_id(spark):
    df = spark.createDataFrame([(3, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (4, [0.6, 0.4])], "id long, probs array<double>")
    assert [r["id"] for r in A.query_entropy(df, 3).collect()] == [1, 3, 4]
    assert [r["id"] for r in A.query_margin(df, 3).collect()] == [1, 3, 4]
    one = spark.createDataFrame([(1, [1.0])], "id long, probs array<double>")
    assert A.query_margin(one.unionByName(df), 9).collect()[-1]["score"] is None


def test_evaluate_counts_empty_classes_as_zero(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "d")]
    got = M.evaluate(spark.createDataFrame(rows, "label string, prediction string")).first()
    f1 = {"a": 2 * 1 / (3 + 2), "b": 2 * 1 / (1 + 2), "c": 0.0}
    assert got["accuracy"] == 0.4
    assert got["f1"] == round((3 * f1["a"] + f1["b"]) / 5, 4)


def test_move_keeps_every_row(spark):
    df = spark.range(100).withColumn("label", F.lit("x"))
    labeled, pool = df.filter("id < 10"), df.filter("id >= 10")
    more, rest = A.move_to_labeled(labeled, pool, A.query_random(pool, 7))
    assert (more.count(), rest.count()) == (17, 83)
    assert more.unionByName(rest).distinct().count() == 100


@pytest.mark.parametrize("model", M.MODELS)
def test_models_learn_and_give_probabilities(spark, model):
    df = corpus(spark, 3)
    features = X.TermFeatures(max_features=60)
    classifier = M.train(features.prepare(df), features, model)
    out = M.predict(classifier, df)
    rows = out.collect()
    assert len(rows) == df.count()
    assert all(r["label"] == r["predicted_label"] for r in rows)
    for r in rows:
        assert r["prob_good"] + r["prob_bad"] == pytest.approx(1, abs=2e-4)
        assert r["confidence"] == max(r["prob_good"], r["prob_bad"])
    unknown = unified(spark, ["zzz qqq"])
    assert M.predict(classifier, unknown).first()["predicted_label"] in ("good", "bad")


def test_margins_agree_with_vector_scoring(spark):
    df = corpus(spark, 2)
    features = X.TermFeatures()
    prepared = features.prepare(df)
    classifier = M.train(prepared, features)
    joined = {r["id"]: r["probs"] for r in classifier.probabilities(prepared).collect()}
    vectors = classifier.model.transform(features.vectors(prepared)).collect()
    for r in vectors:
        assert joined[r["id"]] == pytest.approx(list(r["probability"]), abs=1e-9)


@pytest.mark.parametrize("kind", ["terms", "dense"])
def test_saved_model_predicts_the_same(spark, tmp_path, kind):
    if kind == "terms":
        df, features = corpus(spark, 2), X.TermFeatures(50)
    else:
        df = spark.createDataFrame([(i, [float(i), float(i % 3)], "hi" if i > 10 else "lo") for i in range(20)], "id long, embedding array<double>, label string")
        features = X.DenseFeatures("embedding")
    classifier = M.train(features.prepare(df), features)
    classifier.metadata = {"accuracy": 0.9}
    loaded = M.load_model(M.save_model(classifier, str(tmp_path / "m"), spark), spark)
    assert M.model_info(loaded)["accuracy"] == 0.9

    def answers(c):
        return sorted((r["id"], r["predicted_label"], r["confidence"]) for r in M.predict(c, df).collect())

    assert answers(loaded) == answers(classifier)


def test_single_class_training(spark):
    df = unified(spark, ["a b", "c d"], ["only", "only"])
    features = X.TermFeatures()
    out = M.predict(M.train(features.prepare(df), features), df).collect()
    assert {(r["predicted_label"], r["confidence"]) for r in out} == {("only", 1.0)}


@pytest.mark.parametrize("strategy", A.STRATEGIES)
def test_cycle_history(spark, strategy):
    seed, pool, test = parts(A.stratified_split(corpus(spark), seed_size=8))
    run = [A.al_cycle(seed, pool, test, strategy, n_iterations=2, batch=5, max_features=80)[0].collect() for _ in range(2)]
    assert run[0] == run[1]
    assert [r["n_labeled"] for r in run[0]] == [8, 13, 18]
    assert [r["iteration"] for r in run[0]] == [0, 1, 2]
    assert all(0 <= r["accuracy"] <= 1 for r in run[0])


def test_cycle_stops_when_the_pool_is_empty(spark):
    seed, pool, test = parts(A.stratified_split(corpus(spark, 2), seed_size=8))
    history, classifier = A.al_cycle(seed, pool, test, "entropy", n_iterations=9, batch=3, max_features=60)
    assert [r["n_labeled"] for r in history.collect()] == [8, 11, 12]
    assert classifier.metadata["n_labeled"] == 12
    with pytest.raises(ValueError):
        A.al_cycle(seed, pool, test, "best")


def histories(spark, curves):
    rows = [(i, 50 + 20 * i, acc, acc - 0.01, name, "text", "logreg") for name, curve in curves.items() for i, acc in enumerate(curve)]
    return spark.createDataFrame(rows, HISTORY)


def test_savings(spark):
    h = histories(spark, {"entropy": [0.5, 0.8, 0.9], "margin": [0.1, 0.2, 0.3], "random": [0.4, 0.6, 0.7]})
    got = {r["strategy"]: (r["n_to_match"], r["saved"], r["saved_pct"]) for r in A.savings_vs_random(h).collect()}
    assert got == {"entropy": (70, 20, 22.0), "margin": (90, 0, 0.0)}
    assert A.savings_entropy_clamped(h).first().asDict() == {"examples_saved": 20, "pct_saved": 22.2, "entropy_n_to_match": 70, "random_n_final": 90}
    assert A.savings_at_95pct(h).first().asDict() == {"target": 0.855, "entropy_n": 90, "random_n": None, "saved": None}
    assert {r["strategy"]: r["first_iteration"] for r in A.iterations_to_target(h, 0.6).collect()} == {"entropy": 1, "margin": None, "random": 1}
    assert A.entropy_lift(h).first().asDict() == {"entropy": 0.9, "random": 0.7, "lift": 0.2, "helps": True}
    assert {r["strategy"]: r["best"] for r in A.strategy_summary(h).collect()} == {"entropy": True, "margin": False, "random": False}


def test_savings_when_random_is_never_matched_or_absent(spark):
    h = histories(spark, {"entropy": [0.1, 0.2], "random": [0.5, 0.9]})
    assert A.savings_entropy_clamped(h).count() == 0
    longer = histories(spark, {"entropy": [0.1, 0.2, 0.3], "random": [0.5, 0.9]})
    assert A.savings_vs_random(longer).first()["saved"] == -20
    alone = histories(spark, {"entropy": [0.1, 0.2]})
    assert A.savings_vs_random(alone).count() == 0
    assert A.entropy_lift(alone).first()["helps"] is False


def test_not_enough_rows(spark):
    got = A.al_ready(unified(spark, ["a"] * 3, ["x", "y", "unlabeled"])).collect()
    assert {(r["label"], r["n"], r["labeled"], r["enough"]) for r in got} == {("x", 1, 2, False), ("y", 1, 2, False)}


def test_extractor_choice(spark):
    text = unified(spark, ["a"])
    vectors = spark.createDataFrame([(1, [0.5])], "id long, embedding array<double>")
    assert X.features_for(text, "text").kind == "tfidf"
    assert X.features_for(text, "sound").kind == "tfidf"
    assert X.features_for(vectors, "image").kind == "embedding"
    assert X.features_for(unified(spark, ['{"a": 1}']), "tabular").kind == "tabular"
    assert np.isclose(X.embedding_features(vectors).first()["scaled"][0], 0.0)


def test_registered_cycles_are_whole(spark, sf, monkeypatch):
    """The cycles leave iterations and strategies to the operators, whose limits are the reference's."""
    from inspect import signature

    from catalog import learning, reports
    from siltworks.operators.active import STRATEGIES, al_cycle
    from siltworks.operators.models import SVM_ITERATIONS, estimator

    told, config = [], []
    monkeypatch.setattr(learning.A, "al_cycle", lambda *a, **k: told.append(signature(al_cycle).bind(*a, **k)) or (None, None))
    monkeypatch.setattr(reports, "run_stages", lambda spark, sources, c: config.append(c) or {"data_card": None})
    learning.al_cycle(spark, sf), learning.al_cycle_embedding(spark, sf), reports.end_to_end(spark, sf)
    for bound in told:
        bound.apply_defaults()
    assert [b.arguments["n_iterations"] for b in told] == [5, 5]
    assert config[0].iterations == 5 and tuple(config[0].al_strategies) == tuple(STRATEGIES)
    assert SVM_ITERATIONS == 2000 and estimator("rf", 10).getMaxDepth() == 30


# ---- radial kernels


def rings(spark, n=200, seed=0):
    rng = np.random.default_rng(seed)
    angle = rng.uniform(0, 2 * np.pi, n)
    inner = np.arange(n) % 2 == 0
    radius = np.where(inner, 1.0, 3.0) + rng.normal(0, 0.45, n)
    x = np.column_stack([radius * np.cos(angle), radius * np.sin(angle)])
    rows = [(i, list(map(float, x[i])), "in" if inner[i] else "out") for i in range(n)]
    return x, inner, spark.createDataFrame(rows, "id long, embedding array<double>, label string")


def kernel_solver(x, t, gamma, c=1.0):
    """Plain SMO on the exact kernel; returns the decision function."""
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    a, g = np.zeros(len(x)), -np.ones(len(x))
    for _ in range(100_000):
        up = np.where(((t > 0) & (a < c - 1e-12)) | ((t < 0) & (a > 1e-12)), -t * g, -np.inf)
        low = np.where(((t > 0) & (a > 1e-12)) | ((t < 0) & (a < c - 1e-12)), -t * g, np.inf)
        i, j = up.argmax(), low.argmin()
        if up[i] - low[j] < 1e-6:
            break
        d = (up[i] - low[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        d = min(d, c - a[i] if t[i] > 0 else a[i], a[j] if t[j] > 0 else c - a[j])
        a[i] += t[i] * d
        a[j] -= t[j] * d
        g += t * d * (k[:, i] - k[:, j])
    bias = (up[i] + low[j]) / 2
    return lambda y: np.exp(-gamma * ((y[:, None] - x[None]) ** 2).sum(-1)) @ (a * t) + bias


def plain_platt(m, t):
    """Gradient descent on Platt's smoothed loss."""
    p, n = (t > 0).sum(), (t < 0).sum()
    want = np.where(t > 0, (p + 1) / (p + 2), 1 / (n + 2))
    a = b = 0.0
    for _ in range(20_000):
        s = 1 / (1 + np.exp(a * m + b))
        a, b = a - 0.5 * ((want - s) * m).mean(), b - 0.5 * (want - s).mean()
    return a, b


def test_svm_separates_rings_like_an_exact_kernel_solver(spark):
    x, inner, df = rings(spark)
    features = X.DenseFeatures("embedding")
    classifier = M.train(features.prepare(df), features, "svm")
    rows = M.predict(classifier, df).collect()
    assert np.mean([r["predicted_label"] == r["label"] for r in rows]) > 0.95
    linear = M.predict(M.train(features.prepare(df), features, "logreg"), df).collect()
    assert np.mean([r["predicted_label"] == r["label"] for r in linear]) < 0.75

    z = (x - x.mean(0)) / x.std(0)
    t = np.where(inner, 1.0, -1.0)
    gamma = 1 / (2 * z.var())
    assert classifier.model.basis.gamma == pytest.approx(gamma)
    held = np.zeros(len(z))
    for f in range(3):
        out = np.arange(len(z)) % 3 == f
        held[out] = kernel_solver(z[~out], t[~out], gamma)(z[out])
    a, b = plain_platt(held, t)
    want = 1 / (1 + np.exp(a * kernel_solver(z, t, gamma)(z) + b))
    got = {r["id"]: r["prob_in"] for r in rows}
    gap = np.abs(np.array([got[i] for i in range(len(z))]) - want)
    assert gap.mean() < 0.03 and gap.max() < 0.2


def test_svm_of_several_classes_and_after_saving(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = {"a": (0, 0), "b": (6, 0), "c": (0, 6), "d": (6, 6)}
    rows = [(i, [float(v) for v in np.array(centres[k]) + rng.normal(0, 0.7, 2)], k) for i, k in enumerate("abcd" * 12)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, label string")
    features = X.DenseFeatures("embedding")
    classifier = M.train(features.prepare(df), features, "svm", directions=64)
    out = M.predict(classifier, df).collect()
    assert all(r["predicted_label"] == r["label"] for r in out)
    assert all(sum(r[f"prob_{k}"] for k in "abcd") == pytest.approx(1, abs=5e-4) for r in out)
    loaded = M.load_model(M.save_model(classifier, str(tmp_path / "m"), spark), spark)
    assert sorted(M.predict(loaded, df).collect()) == sorted(out)


def test_sigmoids_match_a_plain_fit(spark):
    from siltworks.operators.kernel import platt

    rng = np.random.default_rng(2)
    m = rng.normal(0, 2, 400)
    t = np.where(rng.uniform(size=400) < 1 / (1 + np.exp(-1.5 * m + 0.4)), 1.0, -1.0)
    rows = [(p, float(v) * (p + 1), bool(s > 0)) for p in range(2) for v, s in zip(m, t)]
    got = platt(spark.createDataFrame(rows, "pair int, m double, positive boolean"), 3)
    a, b = plain_platt(m, t)
    assert got[0] == pytest.approx((a, b), abs=1e-2) and got[1] == pytest.approx((a / 2, b), abs=1e-2)
    assert got[2][0] == 0.0  # no margins: one half for everything


# ---- the loop's state


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDF") if w in plan]


def test_text_plans_hold_no_python(spark, monkeypatch):
    df = corpus(spark, 3)
    features = X.TermFeatures(max_features=60)
    for model in ("logreg", "rf"):
        seen = []
        for module in (M, X):
            monkeypatch.setattr(module, "as_vectors", lambda d, c="features", plain=X.as_vectors: seen.append(python_nodes(d)) or plain(d, c), raising=False)
        classifier = M.train(features.prepare(df), features, model)
        plan = M.predict(classifier, df)
        monkeypatch.undo()
        assert python_nodes(plan) == [] and seen and not any(seen)
        if model == "logreg":  # scored where the rows are
            assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_key_that_only_a_pick_brings_is_learnt(spark):
    seed = unified(spark, ['{"a": 1}', '{"a": 2}', '{"a": 8}', '{"a": 9}'], ["x", "x", "y", "y"])
    rows = [(10 + i, '{"a": 5, "late": %d}' % (i % 2), "xy"[i % 2], "tabular", "s", None) for i in range(12)]
    pool = spark.createDataFrame(rows + [(None, "{}", "x", "tabular", "s", None)], seed.schema)
    test = spark.createDataFrame([(50 + r[0], *r[1:]) for r in rows], seed.schema)
    history, classifier = A.al_cycle(seed, pool, test, "entropy", n_iterations=3, batch=4, modality="tabular")
    got = history.collect()
    assert [r["n_labeled"] for r in got] == [4, 8, 12, 16]
    assert classifier.features.keys == ["a", "late"] and got[-1]["accuracy"] == 1.0 and got[0]["accuracy"] < 1.0


def test_cycle_keeps_no_picks_in_its_plans(spark, monkeypatch):
    seed, pool, test = parts(A.stratified_split(corpus(spark, 3), seed_size=8))
    plans = []
    plain = A.train
    monkeypatch.setattr(A, "train", lambda rows, *a: plans.append(rows._jdf.queryExecution().analyzed().toString()) or plain(rows, *a))
    A.al_cycle(seed, pool, test, "margin", n_iterations=2, batch=3, max_features=60)
    assert len(plans) == 3 and not any(" IN (" in p for p in plans) and "LeftSemi" in plans[-1]


# ---- wide records


def wide(spark, n=300, width=7000):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        good = i % 2 == 0
        cells = {f"key{k}": int(rng.integers(1, 5)) for k in rng.choice(width, 40, replace=False)}
        cells |= {"common": 5.0 if good else 1.0, "flat": 3}
        rows.append((i, "{" + ", ".join(f'"{k}": {v}' for k, v in cells.items()) + "}", "good" if good else "bad"))
    return rows, spark.createDataFrame(rows, "id long, text string, label string")


def test_more_keys_than_dimensions_of_a_dense_vector(spark, tmp_path):
    import json

    rows, df = wide(spark)
    out, dictionary = X.tabular_rows(df.unionByName(spark.createDataFrame([(None, "{}", "x"), (None, "junk", "x"), (7, None, "x")], df.schema)))
    keys = {r["key"]: r for r in dictionary.collect()}
    n = len(rows) + 3
    values = {k: np.array([float(json.loads(t).get(k, 0)) for _, t, _ in rows] + [0.0] * 3) for k in ("common", "flat", *list(keys)[:20])}
    assert sorted(r["idx"] for r in keys.values()) == list(range(len(keys))) and len(keys) > X.WIDE
    for k, v in values.items():
        assert keys[k]["mean"] == pytest.approx(v.mean()) and keys[k]["std"] == pytest.approx(v.std() or 1.0)
    got = out.collect()
    assert len(got) == n
    for r in got:
        cells = json.loads(r["text"]) if r["text"] not in (None, "junk") else {}
        want = sorted((keys[k]["idx"], v / keys[k]["std"]) for k, v in cells.items())
        assert r["features"]["indices"] == [i for i, _ in want] and r["features"]["values"] == pytest.approx([x for _, x in want])

    features = X.features_for(df, "tabular")
    classifier = M.train(features.prepare(df), features)
    assert features.keys is None and not features.in_vectors
    loaded = M.load_model(M.save_model(classifier, str(tmp_path / "m"), spark), spark)
    for one in (classifier, loaded):
        said = M.predict(one, df).collect()
        assert len(said) == len(rows) and np.mean([r["predicted_label"] == r["label"] for r in said]) == 1.0


def test_constant_keys_of_wide_rows_get_a_deviation_of_one(spark):
    df = spark.createDataFrame([(i, '{"a": 0.1}') for i in range(7)], "id long, text string")
    assert X.tabular_rows(df)[1].first()["std"] == 1.0
    assert X.tabular_rows(df.limit(0))[0].count() == 0


def test_forest_passes_send_no_trees(spark):
    """Rows remember their nodes (before, every pass sent all open trees to its tasks); the trees are the same."""
    rows = np.random.default_rng(3).normal(size=(120, 6)).tolist()
    df = spark.createDataFrame([(r, float(i % 3)) for i, r in enumerate(rows)], "v array<double>, y double")
    df = df.select(X.array_to_vector("v").alias("features"), "y").coalesce(1).persist()
    forest = M.estimator("rf", 120)
    assert forest.getCacheNodeIds()
    trees = forest.fit(df).toDebugString
    assert trees == forest.setCacheNodeIds(False).fit(df).toDebugString
    df.unpersist()


def test_forests_are_grown_a_few_trees_at_a_time(spark, monkeypatch, tmp_path):
    """No group on the driver is larger than its share (before, all trees were held at once); votes are those of all trees."""
    from pyspark.ml.classification import RandomForestClassificationModel

    from siltworks.operators import forest as G

    assert [G.trees_at_once(n, 10, 100) for n in (0, 5_000, 5_001, 51_282, 10**7)] == [100, 100, 50, 9, 1]
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=5) + (i % 3)], "xyz"[i % 3]) for i in range(90)]
    df = spark.createDataFrame([*rows, (None, rows[0][1], "x"), rows[1]], "id long, embedding array<double>, label string")
    sizes = []
    plain = M.RandomForestClassifier.fit
    monkeypatch.setattr(M.RandomForestClassifier, "fit", lambda self, *a: sizes.append((self.getNumTrees(), self.getSeed())) or plain(self, *a))
    monkeypatch.setattr(M, "fit_forest", lambda *a: G.fit_forest(*a, numbers=40 * 92 * 13))
    features = X.DenseFeatures("embedding")
    classifier = M.train(features.prepare(df), features, "rf")
    assert sizes == [(34, 42), (34, 43), (32, 44)] and len(classifier.model.parts) == 3
    loaded = M.load_model(M.save_model(classifier, str(tmp_path / "forest"), spark), spark)
    attached = classifier.features.attach(classifier.prepare(df)).select("id", "features").collect()
    groups = [RandomForestClassificationModel.load(p) for p in classifier.model.parts]
    assert sum(g.getNumTrees for g in groups) == 100
    want = sorted((str(r["id"]), [round(sum(g.predictRaw(r["features"])[k] for g in groups) / 100, 4) for k in range(3)]) for r in attached)
    for one in (classifier, loaded):
        got = M.predict(one, df).collect()
        assert sorted((str(r["id"]), [r["prob_x"], r["prob_y"], r["prob_z"]]) for r in got) == want
        assert np.mean([r["predicted_label"] == r["label"] for r in got]) > 0.9
