"""Active learning: split, query strategies, the cycle and its learning curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.joins import join_small
from siltworks.functions.ranks import hash_cuts, shuffle_key
from siltworks.functions.scratch import materialize, new_path
from siltworks.operators.features import features_for
from siltworks.operators.models import Classifier, evaluate, train
from siltworks.schema import HISTORY, UNLABELED

STRATEGIES = ("entropy", "margin", "random")


def al_ready(df: DataFrame, minimum: int = 100) -> DataFrame:
    """Labeled rows per class, their total, and whether the total is enough."""
    counts = df.filter(F.col("label") != UNLABELED).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(counts.agg(F.sum("n")).scalar(), F.lit(0))
    return counts.select("label", "n", total.alias("labeled"), (total >= minimum).alias("enough"))


def _quota(counts: DataFrame, column: str, wanted: Column, name: str) -> DataFrame:
    """Largest-remainder shares of ``wanted`` over classes, ties by label.

    The table has one row per class.
    """
    total = counts.agg(F.sum(column)).scalar()
    exact = F.col(column) * wanted / total
    based = counts.withColumn("_base", F.floor(exact)).withColumn("_rest", exact - F.floor(exact))
    left = wanted - based.agg(F.sum("_base")).scalar()
    order = F.row_number().over(W.orderBy(F.desc(F.round("_rest", 9)), "label"))
    return based.withColumn(name, (F.col("_base") + (order <= left).cast("int")).cast("long")).drop("_base", "_rest")


def stratified_split(df: DataFrame, test: float = 0.2, seed_size: int = 50, salt: int | str = 42, id: str = "id", digits: int = 3) -> DataFrame:
    """Add ``split`` = test / seed / pool with exact stratified sizes.

    Rows are ordered by ``md5(id:salt)`` inside their class.  The two cut points per
    class are found on ids alone; whole rows are then tagged by comparing their hash
    with the cut points, without moving them.
    """
    rows = df.filter(F.col("label").isNotNull() & (F.col("label") != UNLABELED))
    counts = materialize(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "class-counts")
    n_test = F.ceil(F.lit(test) * counts.agg(F.sum("n")).scalar())
    quota = _quota(counts, "n", n_test, "n_test").withColumn("_left", F.col("n") - F.col("n_test"))
    quota = _quota(quota, "_left", F.least(F.lit(seed_size), quota.agg(F.sum("_left")).scalar()), "n_seed")
    wanted = quota.select(
        "label",
        F.explode(
            F.array(
                F.struct(F.lit("test").alias("name"), F.col("n_test").alias("position")),
                F.struct(F.lit("seed").alias("name"), (F.col("n_test") + F.col("n_seed")).alias("position")),
            )
        ).alias("w"),
    ).select("label", "w.name", "w.position")
    cuts = (
        hash_cuts(rows, wanted, "label", id, salt, digits)
        .groupBy("label")
        .agg(F.max(F.when(F.col("name") == "test", F.col("cut"))).alias("_t"), F.max(F.when(F.col("name") == "seed", F.col("cut"))).alias("_s"))
    )
    at = F.struct(shuffle_key(id, salt).alias("h"), F.col(id).alias("id"))
    tagged = join_small(rows, cuts, "label", "left")
    split = F.when(at <= F.col("_t"), "test").when(at <= F.col("_s"), "seed").otherwise("pool")
    return tagged.select(*df.columns, split.alias("split"))


def entropy_of(probs: Column) -> Column:
    return -F.aggregate(probs, F.lit(0.0), lambda total, p: total + p * F.log(p + 1e-10))


def margin_of(probs: Column) -> Column:
    """Gap between the two largest probabilities, NULL with a single class."""
    ordered = F.sort_array(probs, asc=False)
    return F.get(ordered, F.lit(0)) - F.get(ordered, F.lit(1))


def query_entropy(scored: DataFrame, n: int, probs: str = "probs", id: str = "id") -> DataFrame:
    return scored.select(id, entropy_of(F.col(probs)).alias("score")).orderBy(F.desc("score"), id).limit(n)


def query_margin(scored: DataFrame, n: int, probs: str = "probs", id: str = "id") -> DataFrame:
    return scored.select(id, margin_of(F.col(probs)).alias("score")).orderBy(F.asc_nulls_last("score"), id).limit(n)


def query_random(pool: DataFrame, n: int, salt: int | str = 42, id: str = "id") -> DataFrame:
    return pool.select(id, shuffle_key(id, salt).alias("_h")).orderBy("_h", id).limit(n).select(id)


def move_to_labeled(labeled: DataFrame, pool: DataFrame, picked: DataFrame, id: str = "id") -> tuple[DataFrame, DataFrame]:
    """(labeled plus the picked pool rows, the rest of the pool)."""
    ids = materialize(picked.select(id), "picked")
    small = F.broadcast(ids) if ids.count() <= 200_000 else ids
    return labeled.unionByName(pool.join(small, id, "left_semi")), pool.join(small, id, "left_anti")


def history_record(spark, iteration: int, n_labeled: int, accuracy: float, f1: float, strategy: str, modality: str, model: str) -> DataFrame:
    return spark.createDataFrame([(iteration, n_labeled, accuracy, f1, strategy, modality, model)], HISTORY)


def prepare_parts(
    seed: DataFrame, pool: DataFrame, test: DataFrame, modality: str = "text", mode: str = "tfidf", max_features: int = 10_000
) -> dict[str, DataFrame]:
    """The rows of a cycle with their counted terms (or fields, or vectors), stored by part."""
    features = features_for(seed, modality, mode, max_features=max_features)
    named = (("seed", seed), ("pool", pool.filter("id IS NOT NULL")), ("test", test))
    return {name: materialize(features.prepare(df), f"prepared-{name}") for name, df in named}


def al_cycle(
    seed: DataFrame,
    pool: DataFrame,
    test: DataFrame,
    strategy: str = "entropy",
    n_iterations: int = 5,
    batch: int = 20,
    model: str = "logreg",
    modality: str = "text",
    mode: str = "tfidf",
    max_features: int = 10_000,
    salt: int | str = 42,
    prepared: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, Classifier]:
    """Refit, evaluate, pick, move: ``n_iterations + 1`` evaluations, fewer when the pool runs dry.

    The state of the loop is stored tables: seed, pool and test rows with their counted terms (or
    fields, or vectors), written once, ``selected`` (id, iteration), to which every
    round adds its picks, and the rows of these picks.  The rest of the pool is an anti join
    with ``selected``, so no pick reaches the driver and lineage stays flat.  The features are fitted
    anew on the labeled rows of each round, the keys of tabular rows too.  Pool rows without
    an id cannot be picked and are left out.  ``prepared``, from ``prepare_parts`` of the same
    rows, lets several cycles share the counting.  Returns the history and the final classifier.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; use one of {STRATEGIES}")
    spark = seed.sparkSession
    features = features_for(seed, modality, mode, max_features=max_features)
    prepared = prepare_parts(seed, pool, test, modality, mode, max_features) if prepared is None else prepared
    seed_rows, pool_rows, test_rows = (prepared[name] for name in ("seed", "pool", "test"))
    left, n_labeled = pool_rows.count(), seed_rows.count()
    selected, moved = new_path(spark, "selected"), new_path(spark, "moved")
    id_type = pool_rows.schema["id"].dataType.simpleString()
    labeled, rest, records = seed_rows, pool_rows, []
    for iteration in range(n_iterations + 1):
        if iteration:
            # n_iterations * batch rows at most
            picked = spark.read.schema(f"id {id_type}, iteration int").parquet(selected)
            latest = F.broadcast(picked.filter(F.col("iteration") == iteration - 1).select("id"))
            pool_rows.join(latest, "id", "left_semi").select(*pool_rows.columns).write.mode("append").parquet(moved)
            held = spark.read.schema(pool_rows.schema).parquet(moved).join(F.broadcast(picked.select("id")), "id", "left_semi")
            labeled = seed_rows.unionByName(held.select(*pool_rows.columns))
            rest = pool_rows.join(F.broadcast(picked.select("id")), "id", "left_anti")
        classifier = train(labeled, features, model, n_labeled)
        scored = classifier.scores(test_rows, ("id", "label")).withColumn("prediction", classifier._best())
        metrics = evaluate(scored).first()
        records.append((iteration, n_labeled, metrics["accuracy"], metrics["f1"], strategy, modality, model))
        if iteration == n_iterations or left == 0:
            break
        take = min(batch, left)
        if strategy == "random":
            chosen = query_random(rest, take, f"{salt}:{iteration}")
        else:
            chosen = (query_entropy if strategy == "entropy" else query_margin)(classifier.scores(rest), take)
        chosen.select("id").write.mode("overwrite").parquet(f"{selected}/iteration={iteration}")
        left -= take
        n_labeled += take
    classifier.metadata = {
        "modality": modality,
        "strategy": strategy,
        "n_labeled": n_labeled,
        "accuracy": records[-1][2],
        "f1": records[-1][3],
    }
    return spark.createDataFrame(records, HISTORY), classifier


def learning_curve(histories: DataFrame, metric: str = "accuracy") -> DataFrame:
    return histories.select("strategy", "iteration", "n_labeled", F.col(metric).alias("value")).orderBy("strategy", "n_labeled", "iteration")


def _finals(histories: DataFrame) -> DataFrame:
    """Last record of each strategy."""
    last = F.max_by(F.struct("n_labeled", "accuracy", "f1"), "iteration")
    return histories.groupBy("strategy").agg(last.alias("last")).select("strategy", "last.*")


def strategy_summary(histories: DataFrame) -> DataFrame:
    """Final figures per strategy; the best accuracy is flagged (first name on ties)."""
    finals = _finals(histories)
    best = finals.agg(F.min_by("strategy", F.struct((-F.col("accuracy")).alias("a"), "strategy"))).scalar()
    return finals.select("strategy", "n_labeled", "accuracy", "f1", (F.col("strategy") == best).alias("best"))


def _random_final(histories: DataFrame) -> Column:
    return _finals(histories).filter("strategy = 'random'").select(F.struct("n_labeled", "accuracy")).scalar()


def savings_vs_random(histories: DataFrame) -> DataFrame:
    """Examples saved by each strategy at random's final accuracy (may be negative).

    A strategy that never gets there is charged its own final size.
    """
    goal = _random_final(histories)
    reached = F.min(F.when(F.col("accuracy") >= goal["accuracy"], F.struct("iteration", "n_labeled")))["n_labeled"]
    final = F.max_by("n_labeled", "iteration")
    rows = histories.filter("strategy <> 'random'").groupBy("strategy").agg(F.coalesce(reached, final).alias("n_to_match"))
    saved = goal["n_labeled"] - F.col("n_to_match")
    pct = F.when(goal["n_labeled"] > 0, F.round(saved * 100.0 / goal["n_labeled"], 0)).otherwise(F.lit(0.0))
    return rows.filter(goal.isNotNull()).select(
        "strategy", "n_to_match", goal["n_labeled"].alias("random_n"), saved.alias("saved"), pct.alias("saved_pct")
    )


def savings_entropy_clamped(histories: DataFrame) -> DataFrame:
    """Entropy against random, never below zero; no row when the goal is not reached."""
    goal = _random_final(histories)
    hits = histories.filter(F.col("strategy") == "entropy").filter(F.col("accuracy") >= goal["accuracy"])
    first = hits.agg(F.min(F.struct("iteration", "n_labeled"))["n_labeled"].alias("n")).filter("n IS NOT NULL")
    saved = goal["n_labeled"] - F.col("n")
    return first.select(
        F.greatest(F.lit(0), saved).alias("examples_saved"),
        F.greatest(F.lit(0.0), F.round(saved * 100.0 / goal["n_labeled"], 1)).alias("pct_saved"),
        F.col("n").alias("entropy_n_to_match"),
        goal["n_labeled"].alias("random_n_final"),
    )


def savings_at_95pct(histories: DataFrame, metric: str = "accuracy", share: float = 0.95) -> DataFrame:
    """Sizes at which entropy and random reach 95 % of entropy's final value."""
    final = histories.filter("strategy = 'entropy'").agg(F.max_by(metric, "iteration")).scalar()
    target = final * share

    def first(strategy: str) -> Column:
        hit = (F.col("strategy") == strategy) & (F.col(metric) >= target)
        return F.min(F.when(hit, F.struct("iteration", "n_labeled")))["n_labeled"]

    rows = histories.agg(F.round(F.max(target), 6).alias("target"), first("entropy").alias("entropy_n"), first("random").alias("random_n"))
    return rows.select("target", "entropy_n", "random_n", (F.col("random_n") - F.col("entropy_n")).alias("saved"))


def iterations_to_target(histories: DataFrame, target: float, metric: str = "accuracy") -> DataFrame:
    hit = F.min(F.when(F.col(metric) >= target, F.col("iteration")))
    return histories.groupBy("strategy").agg(hit.alias("first_iteration"))


def entropy_lift(histories: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Final accuracy of entropy minus random, flagged above the threshold."""
    row = _finals(histories).agg(
        F.max(F.when(F.col("strategy") == "entropy", F.col("accuracy"))).alias("entropy"),
        F.max(F.when(F.col("strategy") == "random", F.col("accuracy"))).alias("random"),
    )
    lift = F.col("entropy") - F.col("random")
    return row.select("entropy", "random", F.round(lift, 6).alias("lift"), F.coalesce(lift > threshold, F.lit(False)).alias("helps"))
