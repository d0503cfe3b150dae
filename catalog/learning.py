"""Feature, active-learning, model and alignment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, table, view
from siltworks.functions.scratch import materialize, new_path
from siltworks.operators import active as A
from siltworks.operators import align as L
from siltworks.operators import features as X
from siltworks.operators import models as M

# ---- features

_WORDS = r"w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS tokens FROM documents)"
_TERMS = """t AS (SELECT id, tokens, list_concat(tokens, CASE WHEN len(tokens) < 2 THEN [] ELSE
        list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]) END) AS terms FROM w)"""


def _docs(spark, sf):
    return table(spark, sf, "documents", spread=True).select(F.col("doc_id").alias("id"), "text")


@query("tokenize", f"WITH {_WORDS}, {_TERMS} SELECT id, array_to_string(tokens, ' ') AS tokens, array_to_string(terms, '|') AS terms FROM t")
def tokenize(spark, sf):
    return X.tokenize(_docs(spark, sf)).select("id", F.concat_ws(" ", "tokens").alias("tokens"), F.concat_ws("|", "terms").alias("terms"))


_VOCAB = """o AS (SELECT id, unnest(terms) AS term FROM t), tf AS (SELECT id, term, count(*) AS tf FROM o GROUP BY id, term),
    v AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx FROM (
        SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM tf GROUP BY term ORDER BY 2 DESC, term LIMIT 10000))"""


@query("tfidf_vocabulary", f"WITH {_WORDS}, {_TERMS}, {_VOCAB} SELECT term, tf, df, CAST(idx AS INT) AS idx FROM v")
def tfidf_vocabulary(spark, sf):
    return X.tfidf_vocabulary(_docs(spark, sf))


@query(
    "tfidf_weights",
    f"""WITH {_WORDS}, {_TERMS}, {_VOCAB}, n AS (SELECT count(*) AS n FROM documents),
        x AS (SELECT tf.id, tf.term, (1 + ln(tf.tf)) * (ln((1e0 + n) / (1e0 + v.df)) + 1) AS w FROM tf JOIN v USING (term), n)
        SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM x""",
)
def tfidf_weights(spark, sf):
    counted = materialize(X.document_terms(_docs(spark, sf)), "terms")
    vocab = X.tfidf_vocabulary(counted)
    return X.tfidf_weights(counted, vocab, counted.count()).select("id", "term", F.round("weight", 6).alias("weight"))


@query(
    "to_vectors",
    f"""WITH {_WORDS}, {_TERMS}, {_VOCAB} SELECT tf.id, CAST(10000 AS INT) AS size, CAST(count(*) AS INT) AS entries, 1e0 AS norm
        FROM tf JOIN v USING (term) GROUP BY tf.id""",
)
def to_vectors(spark, sf):
    """Size, filled entries and length of each row's sparse vector."""
    counted = materialize(X.document_terms(_docs(spark, sf)), "terms")
    vocab = X.tfidf_vocabulary(counted)
    vectors = X.to_vectors(X.tfidf_weights(counted, vocab, counted.count()), X.MAX_FEATURES)
    # the stored entries alone: a dense copy holds ten thousand numbers a row
    sparse = vectors.select("id", F.unwrap_udt("features").alias("v"))
    filled = F.filter("v.values", lambda x: x != 0)
    norm = F.sqrt(F.aggregate(filled, F.lit(0.0), lambda a, x: a + x * x))
    return sparse.select("id", F.col("v.size").alias("size"), F.size(filled).alias("entries"), F.round(norm, 6).alias("norm"))


_SCALED = """u AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS dim, unnest(embedding) AS x FROM embeddings),
    s AS (SELECT dim, avg(CAST(x AS DOUBLE)) AS m, stddev_pop(CAST(x AS DOUBLE)) AS d FROM u {w} GROUP BY dim)
    SELECT u.id, CAST(u.dim AS INT) AS dim, round((CAST(x AS DOUBLE) - m) / CASE WHEN d = 0 THEN 1 ELSE d END, 5) AS x FROM u JOIN s USING (dim)"""


def _long(df, vec):
    return df.select("id", F.posexplode(vec).alias("dim", "x")).withColumn("x", F.round("x", 5))


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


@query("standard_scale", f"WITH {_SCALED.format(w='')}")
def standard_scale(spark, sf):
    return _long(X.standard_scale(_vectors(spark, sf), "embedding"), "scaled")


@query("embedding_features", f"WITH {_SCALED.format(w='WHERE id IN (SELECT vec_id FROM embeddings WHERE label < 5)')}")
def embedding_features(spark, sf):
    """Statistics fitted on half of the classes, applied to all rows."""
    df = _vectors(spark, sf)
    return _long(X.embedding_features(df, stats=X.scale_stats(df.filter("label < 5"), "embedding")), "scaled")


_TAB = """j AS (SELECT event_id AS id, CASE WHEN event_id % 13 = 0 THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k, value AS v FROM events),
    s AS (SELECT avg(k) AS mk, stddev_pop(k) AS sk, avg(v) AS mv, stddev_pop(v) AS sv FROM j)"""


@query("tabular_features", f"WITH {_TAB} SELECT id, round((k - mk) / sk, 6) AS k, round((v - mv) / sv, 6) AS v FROM j, s")
def tabular_features(spark, sf):
    """Two keys per row; every 13th row has no number under ``k``."""
    k = F.when(F.col("event_id") % 13 == 0, '"none"').otherwise(F.regexp_extract("props", r'"k": (\d+)', 1))
    text = F.concat(F.lit('{"v": '), F.col("value").cast("string"), F.lit(', "k": '), k, F.lit("}"))
    df = table(spark, sf, "events").select(F.col("event_id").alias("id"), text.alias("text"))
    out = X.tabular_features(df)
    return out.select("id", F.round(F.get("scaled", F.lit(0)), 6).alias("k"), F.round(F.get("scaled", F.lit(1)), 6).alias("v"))


@query(
    "tabular_wide",
    """WITH e AS (SELECT event_id AS id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v FROM events
                 UNION ALL SELECT event_id, 'user' || user_id, 1e0 FROM events
                 UNION ALL SELECT event_id, 'slot' || (event_id % 20011), value FROM events),
        n AS (SELECT count(*) AS n FROM events),
        d AS (SELECT key, sum(v) / n AS mean, sum(v * v) / n - (sum(v) / n) * (sum(v) / n) AS var FROM e, n GROUP BY key, n),
        s AS (SELECT key, CASE WHEN var <= 1e-14 * mean * mean THEN 1 ELSE sqrt(var) END AS std FROM d)
        SELECT id, (SELECT CAST(count(*) AS INT) FROM s) AS size, CAST(count(*) FILTER (v <> 0) AS INT) AS entries, round(sum(v / std), 4) AS total
        FROM e JOIN s USING (key) GROUP BY id""",
)
def tabular_wide(spark, sf):
    """Records over tens of thousands of keys: a common one, one per user, one per slot."""
    text = F.concat(
        F.lit('{"k": '), F.regexp_extract("props", r'"k": (\d+)', 1), F.lit(', "user'), F.col("user_id").cast("string"), F.lit('": 1, "slot'),
        (F.col("event_id") % 20011).cast("string"), F.lit('": '), F.col("value").cast("string"), F.lit("}"),
    )
    rows, _ = X.tabular_rows(table(spark, sf, "events").select(F.col("event_id").alias("id"), text.alias("text")))
    total = F.aggregate("features.values", F.lit(0.0), lambda a, x: a + x)
    return rows.select("id", F.col("features.size").alias("size"), F.size("features.values").alias("entries"), F.round(total, 4).alias("total"))


@query(
    "features_for",
    f"""WITH {_WORDS}, {_TERMS}, o AS (SELECT DISTINCT unnest(terms) AS term FROM t)
        SELECT 'text' AS modality, 'tfidf' AS kind, CAST(least(10000, count(*)) AS INT) AS dimensions FROM o
        UNION ALL SELECT 'image', 'embedding', CAST(max(len(embedding)) AS INT) FROM embeddings
        UNION ALL SELECT 'tabular', 'tabular', CAST(count(DISTINCT k) AS INT) FROM (SELECT unnest(json_keys(props)) AS k FROM events)""",
)
def features_for(spark, sf):
    """The extractor chosen for each modality, fitted on its own rows."""
    events = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("props").alias("text"))
    chosen = [(_docs(spark, sf), "text"), (_vectors(spark, sf), "image"), (events, "tabular")]
    rows = []
    for df, modality in chosen:
        f = X.features_for(df, modality)
        f.fit(f.prepare(df))
        rows.append((modality, f.kind, len(f.vocab) if f.kind == "tfidf" else len(f.mean)))
    return spark.createDataFrame(rows, "modality string, kind string, dimensions int")


# ---- active learning

@query(
    "al_ready",
    """WITH c AS (SELECT label, count(*) AS n FROM corpus WHERE label <> 'unlabeled' GROUP BY label)
       SELECT label, n, (SELECT CAST(sum(n) AS BIGINT) FROM c) AS labeled, (SELECT sum(n) FROM c) >= 100 AS enough FROM c""",
    ["corpus"],
)
def al_ready(spark, sf):
    return A.al_ready(view(spark, sf, "corpus"))


_SPLIT = """
    WITH r AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) AS rk FROM corpus WHERE label <> 'unlabeled'),
    c AS (SELECT label, count(*) AS n FROM r GROUP BY label), t AS (SELECT sum(n) AS total, ceil(0.2e0 * sum(n)) AS want FROM c),
    q AS (SELECT label, n, floor(n * want / total) AS base, round(n * want / total - floor(n * want / total), 9) AS rest, want FROM c, t),
    q1 AS (SELECT label, n, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= want - (SELECT sum(base) FROM q) THEN 1 ELSE 0 END AS n_test FROM q),
    t2 AS (SELECT sum(n - n_test) AS total, least(50e0, sum(n - n_test)) AS want FROM q1),
    p AS (SELECT label, n_test, floor((n - n_test) * want / total) AS base, round((n - n_test) * want / total - floor((n - n_test) * want / total), 9) AS rest, want FROM q1, t2),
    p1 AS (SELECT label, n_test, n_test + base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= want - (SELECT sum(base) FROM p) THEN 1 ELSE 0 END AS upto FROM p)
    SELECT id, r.label, CASE WHEN rk <= n_test THEN 'test' WHEN rk <= upto THEN 'seed' ELSE 'pool' END AS split FROM r JOIN p1 ON r.label = p1.label"""


@query("stratified_split", _SPLIT, ["corpus"])
def stratified_split(spark, sf):
    return A.stratified_split(view(spark, sf, "corpus")).select("id", "label", "split")


_ENTROPY = "-(p0 * ln(p0 + 1e-10) + p1 * ln(p1 + 1e-10) + p2 * ln(p2 + 1e-10))"
_TOP2 = "greatest(p0, p1, p2) - (p0 + p1 + p2 - greatest(p0, p1, p2) - least(p0, p1, p2))"


def _scored(spark, sf):
    return view(spark, sf, "scored").select("id", F.array("p0", "p1", "p2").alias("probs"))


@query("query_entropy", f"SELECT id, round({_ENTROPY}, 6) AS score FROM scored ORDER BY {_ENTROPY} DESC, id LIMIT 20", ["scored"])
def query_entropy(spark, sf):
    return A.query_entropy(_scored(spark, sf), 20).withColumn("score", F.round("score", 6))


@query("query_margin", f"SELECT id, round({_TOP2}, 6) AS score FROM scored ORDER BY {_TOP2}, id LIMIT 20", ["scored"])
def query_margin(spark, sf):
    return A.query_margin(_scored(spark, sf), 20).withColumn("score", F.round("score", 6))


_RANDOM = "SELECT id FROM corpus ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id LIMIT 20"


@query("query_random", _RANDOM, ["corpus"])
def query_random(spark, sf):
    return A.query_random(view(spark, sf, "corpus"), 20)


@query(
    "move_to_labeled",
    f"""WITH picked AS (SELECT id FROM (SELECT id FROM corpus WHERE label = 'unlabeled') ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id LIMIT 20)
        SELECT id, text, 'labeled' AS part FROM corpus WHERE label <> 'unlabeled' OR id IN (SELECT id FROM picked)
        UNION ALL SELECT id, text, 'pool' FROM corpus WHERE label = 'unlabeled' AND id NOT IN (SELECT id FROM picked)""",
    ["corpus"],
)
def move_to_labeled(spark, sf):
    df = view(spark, sf, "corpus").select("id", "text", "label")
    labeled, pool = df.filter("label <> 'unlabeled'"), df.filter("label = 'unlabeled'")
    labeled, pool = A.move_to_labeled(labeled, pool, A.query_random(pool, 20))
    return labeled.withColumn("part", F.lit("labeled")).unionByName(pool.withColumn("part", F.lit("pool"))).drop("label")


_EVALUATED = """
    WITH k AS (SELECT label AS c FROM predictions UNION SELECT prediction FROM predictions),
    m AS (SELECT c, (SELECT count(*) FROM predictions WHERE label = c AND prediction = c) AS tp, (SELECT count(*) FROM predictions WHERE label = c) AS s,
                 (SELECT count(*) FROM predictions WHERE prediction = c) AS p FROM k)
    SELECT {extra}round(1e0 * sum(tp) / sum(s), 4) AS accuracy, round(sum(CASE WHEN s + p = 0 THEN 0 ELSE 2e0 * tp / (s + p) END * s) / sum(s), 4) AS f1 FROM m"""


@query("evaluate", _EVALUATED.format(extra=""), ["predictions"])
def evaluate(spark, sf):
    return M.evaluate(view(spark, sf, "predictions"))


@query(
    "history_record",
    _EVALUATED.format(extra="CAST(0 AS INT) AS iteration, CAST(sum(s) AS BIGINT) AS n_labeled, 'entropy' AS strategy, 'image' AS modality, 'logreg' AS model, "),
    ["predictions"],
)
def history_record(spark, sf):
    df = view(spark, sf, "predictions")
    figures = M.evaluate(df).first()
    return A.history_record(spark, 0, df.count(), figures["accuracy"], figures["f1"], "entropy", "image", "logreg")


@query("learning_curve", "SELECT strategy, iteration, n_labeled, accuracy AS value FROM histories", ["histories"])
def learning_curve(spark, sf):
    return A.learning_curve(view(spark, sf, "histories"))


_FIN = "f AS (SELECT strategy, n_labeled, accuracy, f1 FROM (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY iteration DESC) AS rn FROM histories) WHERE rn = 1)"


@query(
    "strategy_summary",
    f"WITH {_FIN} SELECT *, strategy = (SELECT strategy FROM f ORDER BY accuracy DESC, strategy LIMIT 1) AS best FROM f",
    ["histories"],
)
def strategy_summary(spark, sf):
    return A.strategy_summary(view(spark, sf, "histories"))


@query(
    "savings_vs_random",
    f"""WITH {_FIN}, r AS (SELECT * FROM f WHERE strategy = 'random'),
        m AS (SELECT strategy, min(n_labeled) FILTER (accuracy >= (SELECT accuracy FROM r)) AS hit, max(n_labeled) AS last FROM histories WHERE strategy <> 'random' GROUP BY strategy)
        SELECT m.strategy, coalesce(hit, last) AS n_to_match, r.n_labeled AS random_n, r.n_labeled - coalesce(hit, last) AS saved,
               round(1e2 * (r.n_labeled - coalesce(hit, last)) / r.n_labeled, 0) AS saved_pct FROM m, r""",
    ["histories"],
)
def savings_vs_random(spark, sf):
    return A.savings_vs_random(view(spark, sf, "histories"))


@query(
    "savings_entropy_clamped",
    f"""WITH {_FIN}, r AS (SELECT * FROM f WHERE strategy = 'random'),
        m AS (SELECT min(n_labeled) AS n FROM histories WHERE strategy = 'entropy' AND accuracy >= (SELECT accuracy FROM r))
        SELECT greatest(0, r.n_labeled - n) AS examples_saved, greatest(0e0, round(1e2 * (r.n_labeled - n) / r.n_labeled, 1)) AS pct_saved,
               n AS entropy_n_to_match, r.n_labeled AS random_n_final FROM m, r WHERE n IS NOT NULL""",
    ["histories"],
)
def savings_entropy_clamped(spark, sf):
    return A.savings_entropy_clamped(view(spark, sf, "histories"))


@query(
    "savings_at_95pct",
    f"""WITH {_FIN}, g AS (SELECT accuracy * 0.95e0 AS target FROM f WHERE strategy = 'entropy'),
        m AS (SELECT round(max(target), 6) AS target, min(n_labeled) FILTER (strategy = 'entropy' AND accuracy >= target) AS entropy_n,
                     min(n_labeled) FILTER (strategy = 'random' AND accuracy >= target) AS random_n FROM histories, g)
        SELECT *, random_n - entropy_n AS saved FROM m""",
    ["histories"],
)
def savings_at_95pct(spark, sf):
    return A.savings_at_95pct(view(spark, sf, "histories"))


@query("iterations_to_target", "SELECT strategy, min(iteration) FILTER (accuracy >= 0.7) AS first_iteration FROM histories GROUP BY strategy", ["histories"])
def iterations_to_target(spark, sf):
    return A.iterations_to_target(view(spark, sf, "histories"), 0.7)


@query(
    "entropy_lift",
    f"""WITH {_FIN} SELECT e.accuracy AS entropy, r.accuracy AS random, round(e.accuracy - r.accuracy, 6) AS lift, e.accuracy - r.accuracy > 0.01 AS helps
        FROM f e, f r WHERE e.strategy = 'entropy' AND r.strategy = 'random'""",
    ["histories"],
)
def entropy_lift(spark, sf):
    return A.entropy_lift(view(spark, sf, "histories"))


# ---- models: checked by unit tests, no SQL

def _text_split(spark, sf):
    rows = view(spark, sf, "corpus", spread=True).filter("modality = 'text' AND label <> 'unlabeled'")
    return materialize(A.stratified_split(rows), "split")


def _part(df, name):
    return df.filter(F.col("split") == name).drop("split")


@query("train")
def train(spark, sf):
    """Logistic regression on the labeled documents, measured on the held-out ones."""
    split = _text_split(spark, sf)
    features = X.TermFeatures()
    prepared = materialize(features.prepare(split), "prepared")
    classifier = M.train(prepared.filter("split <> 'test'"), features)
    held = prepared.filter("split = 'test'")
    return M.evaluate(classifier.classify(held).join(held.select("id", "label"), "id"))


def _embedding_model(spark, sf, model):
    rows = _vectors(spark, sf).withColumn("label", F.concat(F.lit("c"), F.col("label").cast("string")))
    features = X.DenseFeatures("embedding")
    return rows, M.train(features.prepare(rows), features, model)


@query("predict")
def predict(spark, sf):
    rows, classifier = _embedding_model(spark, sf, "logreg")
    return M.predict(classifier, rows).drop("embedding")


@query("predict_svm")
def predict_svm(spark, sf):
    rows, classifier = _embedding_model(spark, sf, "svm")
    return M.predict(classifier, rows).drop("embedding")


@query("predict_forest")
def predict_forest(spark, sf):
    rows, classifier = _embedding_model(spark, sf, "rf")
    return M.predict(classifier, rows).drop("embedding")


@query(
    "prediction_distribution",
    "SELECT prediction AS value, count(*) AS n, round(1e2 * count(*) / (SELECT count(*) FROM predictions), 1) AS pct FROM predictions GROUP BY prediction",
    ["predictions"],
)
def prediction_distribution(spark, sf):
    return M.prediction_distribution(view(spark, sf, "predictions").withColumnRenamed("prediction", "predicted_label"))


@query("save_model")
def save_model(spark, sf):
    """Predictions of a model that was saved and loaded again."""
    rows, classifier = _embedding_model(spark, sf, "logreg")
    loaded = M.load_model(M.save_model(classifier, new_path(spark, "model"), spark), spark)
    return M.predict(loaded, rows).select("id", "predicted_label", "confidence")


@query("al_cycle")
def al_cycle(spark, sf):
    split = _text_split(spark, sf)
    history, _ = A.al_cycle(_part(split, "seed"), _part(split, "pool"), _part(split, "test"), "entropy")
    return history


@query("al_cycle_embedding")
def al_cycle_embedding(spark, sf):
    rows = _vectors(spark, sf).withColumn("label", F.concat(F.lit("c"), F.col("label").cast("string")))
    split = materialize(A.stratified_split(rows), "split")
    history, _ = A.al_cycle(
        _part(split, "seed"), _part(split, "pool"), _part(split, "test"), "margin", modality="image", mode="embedding"
    )
    return history


# ---- alignment

def _modalities(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang")
    marks = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic")
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url")
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return {"text": docs, "mark": marks, "page": pages, "image": vectors}


_ALIGNED = """aligned AS (SELECT coalesce(d.doc_id, l.doc_id, p.page_id, e.vec_id) AS id, d.lang AS text_lang, l.quality AS mark_quality, l.toxic AS mark_toxic,
    p.url AS page_url, e.label AS image_label, d.doc_id IS NOT NULL AS has_text, l.doc_id IS NOT NULL AS has_mark, p.page_id IS NOT NULL AS has_page, e.vec_id IS NOT NULL AS has_image
    FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id FULL OUTER JOIN pages p ON coalesce(d.doc_id, l.doc_id) = p.page_id
    FULL OUTER JOIN embeddings e ON coalesce(d.doc_id, l.doc_id, p.page_id) = e.vec_id)"""
_NAMES = ["text", "mark", "page", "image"]


@query("align_by_id", f"WITH {_ALIGNED} SELECT * FROM aligned")
def align_by_id(spark, sf):
    return L.align_by_id(_modalities(spark, sf))


def _asof_sql(tolerance: str) -> str:
    return f"""
    WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type IN ('purchase', 'error', 'signup')),
    r AS (SELECT user_id, ts, max(event_id) AS rid FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id, ts),
    j AS (SELECT l.event_id, l.user_id, l.ts, r.rid, r.ts AS rts FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts)
    SELECT event_id, user_id, CASE WHEN {tolerance} THEN rid END AS right_id, CASE WHEN {tolerance} THEN date_diff('microsecond', rts, ts) END AS gap_micros FROM j"""


def _asof(spark, sf, tolerance):
    events = table(spark, sf, "events")
    left = events.filter("event_type IN ('purchase', 'error', 'signup')").select("event_id", "user_id", "ts")
    right = events.filter("event_type IN ('view', 'click')").select(F.col("event_id").alias("id"), "user_id", "ts")
    out = L.align_asof(left, right, "user_id", "ts", tolerance)
    return out.select("event_id", "user_id", "right_id", F.timestamp_diff("MICROSECOND", "right_ts", "ts").alias("gap_micros"))


@query("align_asof", _asof_sql("true"))
def align_asof(spark, sf):
    return _asof(spark, sf, None)


@query("align_asof_tolerance", _asof_sql("date_diff('microsecond', rts, ts) <= 21600000000"))
def align_asof_tolerance(spark, sf):
    return _asof(spark, sf, 6 * 3600)


_SETS = [("text",), ("mark",), ("page",), ("image",), ("text", "mark"), ("text", "page"), ("text", "image"), ("mark", "page"), ("mark", "image"), ("page", "image"), tuple(_NAMES)]


@query(
    "alignment_coverage",
    f"WITH {_ALIGNED} "
    + " UNION ALL ".join(
        f"SELECT '{'+'.join(s)}' AS modalities, count(*) FILTER ({' AND '.join('has_' + m for m in s)}) AS n, "
        f"round(1e2 * count(*) FILTER ({' AND '.join('has_' + m for m in s)}) / count(*), 2) AS pct FROM aligned"
        for s in _SETS
    ),
)
def alignment_coverage(spark, sf):
    return L.alignment_coverage(L.align_by_id(_modalities(spark, sf)), _NAMES)


@query(
    "joint_label_distribution",
    f"""WITH {_ALIGNED} SELECT CAST(mark_quality AS VARCHAR) AS label_a, CAST(image_label AS VARCHAR) AS label_b, count(*) AS n FROM aligned
        WHERE mark_quality IS NOT NULL AND image_label IS NOT NULL GROUP BY 1, 2""",
)
def joint_label_distribution(spark, sf):
    return L.joint_label_distribution(L.align_by_id(_modalities(spark, sf)), "mark_quality", "image_label")


@query(
    "pair_examples",
    f"WITH {_ALIGNED} "
    + " UNION ALL ".join(
        f"SELECT '{a}+{b}' AS pair, * FROM aligned WHERE id = (SELECT min(id) FROM aligned WHERE has_{a} AND has_{b})" for a, b in [s for s in _SETS if len(s) == 2]
    ),
)
def pair_examples(spark, sf):
    return L.pair_examples(L.align_by_id(_modalities(spark, sf)), _NAMES)
