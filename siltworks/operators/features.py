"""Features: counted terms, TF-IDF as joins, scaled dense vectors."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.binding import let
from siltworks.functions.joins import join_small, join_spread
from siltworks.functions.ranks import hash_rank
from siltworks.functions.scratch import materialize, new_path
from siltworks.functions.stats import one_row
from siltworks.functions.text import bigrams, term_counts, tokens

MAX_FEATURES = 10_000


def tokenize(df: DataFrame, col: str = "text") -> DataFrame:
    """Add ``tokens`` (lower-case, two or more word characters) and ``terms``
    (tokens followed by bigrams)."""
    words = df.withColumn("tokens", tokens(F.coalesce(F.col(col), F.lit(""))))
    return words.withColumn("terms", F.concat("tokens", bigrams(F.col("tokens"))))


def document_terms(df: DataFrame, col: str = "text") -> DataFrame:
    """Replace the text by ``term_counts``: array of (term, tf), counted in the row."""
    counted = tokenize(df, col).withColumn("term_counts", term_counts(F.col("terms")))
    return counted.drop("tokens", "terms", col)


def _counted(df: DataFrame, col: str) -> DataFrame:
    return df if "term_counts" in df.columns else document_terms(df, col)


def _exploded(counted: DataFrame, *keep: str) -> DataFrame:
    """One row per (row, term).  The outer form keeps the optimizer from testing
    ``size(term_counts) > 0`` below, which would count the terms a second time."""
    return counted.select(*keep, F.explode_outer("term_counts").alias("t")).select(*keep, "t.term", "t.tf").filter("term IS NOT NULL")


def tfidf_vocabulary(df: DataFrame, max_features: int = MAX_FEATURES, col: str = "text") -> DataFrame:
    """The most frequent terms with corpus count, document frequency and index.

    Ties in the count are broken by the term; indexes follow the term order.  The final
    ranking sees at most ``max_features`` rows.
    """
    exploded = _exploded(_counted(df, col))
    counts = exploded.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
    top = counts.orderBy(F.desc("tf"), "term").limit(max_features)
    return top.withColumn("idx", F.row_number().over(W.orderBy("term")) - 1)


def idf(n_docs: int | Column, df: Column) -> Column:
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return F.log((1.0 + n) / (1.0 + df)) + 1.0


def tfidf_weights(df: DataFrame, vocab: DataFrame, n_docs: int | Column, col: str = "text", id: str = "id") -> DataFrame:
    """(id, term, idx, weight): (1 + ln tf) * idf, scaled to unit length per row.

    ``vocab`` is broadcast when its counted size allows.  One shuffle brings the
    in-vocabulary terms of a row together for its norm.
    """
    exploded = _exploded(_counted(df, col), id)
    table = vocab.select("term", "idx", idf(n_docs, F.col("df")).alias("idf"))
    weighted = join_small(exploded, table, "term").select(id, F.struct("term", "idx", ((1.0 + F.log("tf")) * F.col("idf")).alias("w")).alias("e"))
    rows = weighted.groupBy(id).agg(F.collect_list("e").alias("es"), F.sqrt(F.sum(F.col("e.w") * F.col("e.w"))).alias("norm"))
    return rows.select(id, "norm", F.explode("es").alias("e")).select(id, "e.term", "e.idx", (F.col("e.w") / F.col("norm")).alias("weight"))


def sparse_row(size: Column | int, indices: Column, values: Column) -> Column:
    """A sparse vector in the form in which vectors are stored."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.struct(F.lit(0).cast("tinyint").alias("type"), size.cast("int").alias("size"), indices.alias("indices"), values.alias("values"))


def as_vectors(df: DataFrame, column: str = "features") -> DataFrame:
    """``df`` stored, its column of ``sparse_row`` read back as vectors.

    Storing is what changes the type, so no row passes through Python.
    """
    spark = df.sparkSession
    path = new_path(spark, "vectors")
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == column else f.dataType) for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def to_vectors(weights: DataFrame, size: int, id: str = "id") -> DataFrame:
    """Long weights to one sparse vector per row, for classifiers that need vectors.

    Ids that several rows have would give vectors with an entry twice; they are refused.
    """
    entries = weights.groupBy(id).agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("entries"))
    once = F.size(F.array_distinct("entries.idx")) == F.size("entries")
    entries = entries.withColumn("entries", F.when(once, F.col("entries")).otherwise(F.raise_error("requirement failed: ids must be unique")))
    row = sparse_row(size, F.transform("entries", lambda e: e["idx"].cast("int")), F.transform("entries", lambda e: e["weight"]))
    return as_vectors(entries.select(id, row.alias("features")))


def scale_stats(df: DataFrame, vec_col: str) -> DataFrame:
    """One row (mean, std) per dimension; population deviation, zero becomes 1."""
    vector = array_to_vector(F.col(vec_col).cast("array<double>"))
    summary = df.filter(F.col(vec_col).isNotNull()).select(Summarizer.metrics("mean", "variance", "count").summary(vector).alias("s"))
    flat = summary.select(vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"), F.col("s.count").alias("n"))
    shrink = (F.col("n") - 1) / F.col("n")
    std = F.transform("var", lambda v: F.when(v * shrink <= 0, F.lit(1.0)).otherwise(F.sqrt(v * shrink)))
    return flat.select("mean", std.alias("std"))


def standard_scale(df: DataFrame, vec_col: str, stats: DataFrame | None = None, out: str = "scaled") -> DataFrame:
    """(x - mean) / std per dimension, with statistics fitted on ``stats`` or ``df``."""
    s = one_row(scale_stats(df, vec_col) if stats is None else stats)
    fitted = df.withColumn("_mean", s["mean"]).withColumn("_std", s["std"])
    centred = F.zip_with(F.col(vec_col).cast("array<double>"), F.col("_mean"), lambda x, m: x - m)
    return fitted.withColumn(out, F.zip_with(centred, F.col("_std"), lambda x, d: x / d)).drop("_mean", "_std")


def field_values(fields: Column, keys: list[str]) -> Column:
    """A map of strings to an array of numbers in key order; missing or bad values are 0."""
    return F.array(*[F.coalesce(F.element_at(fields, F.lit(k)).try_cast("double"), F.lit(0.0)) for k in keys])


def json_numbers(df: DataFrame, keys: list[str], col: str = "text", out: str = "vector") -> DataFrame:
    """JSON objects of numbers to an array in key order; missing or bad values are 0."""
    return df.withColumn("_map", F.from_json(col, "map<string,string>")).withColumn(out, field_values(F.col("_map"), keys)).drop("_map")


def map_keys(df: DataFrame, fields: Column, limit: int = 4096) -> list[str]:
    """Sorted distinct keys; refuses key spaces that could not be vector dimensions."""
    # the outer form avoids an inferred filter that would parse every row twice
    found = df.select(F.explode_outer(F.map_keys(fields)).alias("k")).filter("k IS NOT NULL")
    keys = found.distinct().limit(limit + 1).collect()
    if len(keys) > limit:
        raise ValueError(f"more than {limit} distinct keys; pass the keys explicitly")
    return sorted(r["k"] for r in keys)


def json_keys(df: DataFrame, col: str = "text", limit: int = 4096) -> list[str]:
    return map_keys(df, F.from_json(col, "map<string,string>"), limit)


def tabular_features(df: DataFrame, keys: list[str] | None = None, stats: DataFrame | None = None, col: str = "text") -> DataFrame:
    """JSON rows to scaled vectors."""
    return standard_scale(json_numbers(df, json_keys(df, col) if keys is None else keys, col), "vector", stats)


def embedding_features(df: DataFrame, vec_col: str = "embedding", stats: DataFrame | None = None) -> DataFrame:
    """Precomputed dense vectors, scaled."""
    return standard_scale(df, vec_col, stats)


WIDE = 4096


def key_dictionary(df: DataFrame, fields: str = "fields") -> DataFrame:
    """(key, idx, mean, std): every key of the maps in ``fields``, numbered, with its moments over all rows.

    Rows without the key, or without a number under it, count as 0; a deviation of zero
    becomes 1.  Any number of keys; none reaches the driver.
    """
    rows = df.count()
    entries = df.select(F.explode_outer(fields).alias("key", "text")).filter("key IS NOT NULL")
    number = F.nanvl(F.coalesce(F.col("text").try_cast("double"), F.lit(0.0)), F.lit(0.0))
    sums = entries.select("key", number.alias("v")).groupBy("key").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("ss"))
    ranked = hash_rank(materialize(sums, "key-sums"), "key", 0)
    mean = F.col("s") / rows
    var = F.greatest(F.col("ss") / rows - mean * mean, F.lit(0.0))
    # what is left of a constant after the subtraction is rounding
    std = F.when(var <= 1e-14 * mean * mean, F.lit(1.0)).otherwise(F.sqrt(var))
    found = ranked.select("key", (F.col("rank") - 1).cast("int").alias("idx"), mean.alias("mean"), F.when(std == 0, 1.0).otherwise(std).alias("std"))
    return materialize(found, "keys")


def wide_rows(df: DataFrame, dictionary: DataFrame, fields: str = "fields") -> DataFrame:
    """Replace the map in ``fields`` by ``features``: a ``sparse_row`` of its numbers over their keys' deviations.

    Only entries that are there are stored, so rows are not centred; models with an intercept,
    distances and trees do not see the difference.  Unknown keys are dropped.  Entries are joined
    with the dictionary, keys that very many rows have by a broadcast, and put together per row.
    """
    size = dictionary.count()
    others = [c for c in df.columns if c != fields]
    stored = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "wide-rows")
    number = F.coalesce(F.col("text").try_cast("double"), F.lit(0.0))
    entries = stored.select("_row", F.explode_outer(fields).alias("key", "text")).select("_row", "key", number.alias("v"))
    known = join_spread(entries, dictionary.select("key", "idx", "std"), ["key"])
    entry = F.when(F.col("idx").isNotNull() & (F.col("v") != 0), F.struct("idx", (F.col("v") / F.col("std")).alias("x")))
    rows = known.groupBy("_row").agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    vector = sparse_row(max(1, size), F.transform("_e", lambda e: e["idx"]), F.transform("_e", lambda e: e["x"]))
    return stored.drop(fields).join(rows.select("_row", vector.alias("features")), "_row").select(*others, "features")


def tabular_rows(df: DataFrame, stats: DataFrame | None = None, col: str = "text") -> tuple[DataFrame, DataFrame]:
    """JSON objects of any number of keys to (``df`` with ``features``, the key dictionary fitted on ``stats`` or ``df``)."""
    parsed = lambda d: d.withColumn("fields", F.from_json(col, "map<string,string>"))
    dictionary = key_dictionary(parsed(df if stats is None else stats).select("fields"))
    return wide_rows(parsed(df), dictionary), dictionary


class TermFeatures:
    """TF-IDF extractor: ``prepare`` once, ``fit`` on labeled rows, weigh terms in the row."""

    kind = "tfidf"
    #: ``attach`` gives stored rows, not vectors
    in_vectors = False

    def __init__(self, max_features: int = MAX_FEATURES, col: str = "text"):
        self.max_features, self.col = max_features, col
        self.vocab: list[tuple[str, int, float]] = []

    def prepare(self, df: DataFrame) -> DataFrame:
        return document_terms(df, self.col)

    def fit(self, train: DataFrame) -> None:
        """The vocabulary, at most ``max_features`` entries, is kept on the driver."""
        n_docs = train.count()
        rows = tfidf_vocabulary(train, self.max_features, self.col).select("term", "idx", idf(n_docs, F.col("df")).alias("idf")).collect()
        self.vocab = sorted(((r["term"], r["idx"], r["idf"]) for r in rows), key=lambda r: r[1])

    def table(self, spark: SparkSession) -> DataFrame:
        """The vocabulary as a table."""
        return spark.createDataFrame(self.vocab or [("", 0, 0.0)], "term string, idx int, idf double")

    def attach(self, prepared: DataFrame) -> DataFrame:
        """Replace the term counts by ``features``: a ``sparse_row`` of unit length.

        The vocabulary is looked up inside the row, so no row is moved or split.
        """
        spark, others = prepared.sparkSession, [c for c in prepared.columns if c != "term_counts"]
        repeated = F.flatten(F.transform("term_counts", lambda e: F.array_repeat(e["term"], e["tf"].cast("int"))))
        counter = CountVectorizerModel.from_vocabulary([v[0] for v in self.vocab] or [""], "_terms", "_counts")
        known = spark.createDataFrame([([v[2] for v in self.vocab] or [0.0],)], "idf array<double>").select("idf").scalar()
        counted = counter.transform(prepared.withColumn("_terms", repeated)).select(*others, F.unwrap_udt("_counts").alias("_c"), known.alias("_idf"))
        weights = F.zip_with("_c.indices", "_c.values", lambda i, tf: (1.0 + F.log(tf)) * F.get("_idf", i))

        def unit(ws: Column) -> Column:
            norm = F.sqrt(F.aggregate(ws, F.lit(0.0), lambda a, w: a + w * w))
            return let(norm, lambda n: F.transform(ws, lambda w: w / n))

        row = sparse_row(max(1, len(self.vocab)), F.col("_c.indices"), let(weights, unit))
        return counted.select(*others, row.alias("features"))

    def margins(self, prepared: DataFrame, coefficients: list[list[float]], intercepts: list[float], keep: tuple[str, ...]) -> DataFrame:
        """``keep`` columns and ``margins``, the scores that ``attach`` and ``sparse_margins`` give, up to rounding.

        Terms meet a broadcast of the vocabulary, its weights and coefficients, and are summed per row.  A
        row's terms lie in one task, so the sums, not the terms, are shuffled; ``keep`` should be narrow.
        """
        held = [f"k{i}" for i in range(len(keep))]
        sums = [f"s{c}" for c in range(len(coefficients))]
        known = [(term, weight, *[row[i] for row in coefficients]) for term, i, weight in self.vocab]
        table = prepared.sparkSession.createDataFrame(known or [("", 1.0, *[0.0] * len(sums))], ", ".join(["term string", "idf double", *[f"{s} double" for s in sums]]))
        rows = prepared.select(F.monotonically_increasing_id().alias("_row"), *[F.col(k).alias(h) for k, h in zip(keep, held)], "term_counts")
        entries = rows.select("_row", *held, F.explode_outer("term_counts").alias("t")).select("_row", *held, "t.term", "t.tf")
        w = (1.0 + F.log("tf")) * F.col("idf")
        found = entries.join(F.broadcast(table), "term", "left").groupBy("_row", *held)
        summed = found.agg(F.sqrt(F.sum(w * w)).alias("_norm"), *[F.sum(w * F.col(s)).alias(s) for s in sums])
        scores = [F.lit(b) + F.coalesce(F.col(s) / F.col("_norm"), F.lit(0.0)) for s, b in zip(sums, intercepts)]
        return summed.select(*[F.col(h).alias(k) for k, h in zip(keep, held)], F.array(*scores).alias("margins"))

    def vectors(self, prepared: DataFrame) -> DataFrame:
        """``attach`` with real vectors, stored."""
        return as_vectors(self.attach(prepared))


def sparse_margins(df: DataFrame, coefficients: list[list[float]], intercepts: list[float]) -> DataFrame:
    """Replace the ``sparse_row`` in ``features`` by ``margins``, one linear score per class, inside the row."""
    table = df.sparkSession.createDataFrame([(coefficients, intercepts)], "rows array<array<double>>, bias array<double>")
    s = one_row(table)
    held = df.withColumn("_rows", s["rows"]).withColumn("_bias", s["bias"])

    def scores(entries: Column) -> Column:
        def score(row: Column, c: Column) -> Column:
            return F.aggregate(entries, F.get("_bias", c), lambda a, e: a + e["values"] * F.get(row, e["indices"]))

        return F.transform("_rows", score)

    return held.withColumn("margins", let(F.arrays_zip("features.indices", "features.values"), scores)).drop("_rows", "_bias", "features")


class DenseFeatures:
    """Dense vectors, scaled on the labeled rows: embeddings, or numbers of JSON objects.

    The keys of ``tabular`` rows are those found in the rows given to ``fit``, unless ``keys`` are given.
    With more than ``WIDE`` of them rows are sparse and the keys stay in a table.
    """

    def __init__(self, col: str, keys: list[str] | None = None, tabular: bool = False):
        self.col, self.keys, self.given = col, keys, keys is not None
        self.kind = "tabular" if tabular or self.given else "embedding"
        self.mean: list[float] = []
        self.std: list[float] = []
        self.dictionary: DataFrame | None = None

    @property
    def in_vectors(self) -> bool:
        return self.dictionary is None

    def prepare(self, df: DataFrame) -> DataFrame:
        if self.kind == "tabular":
            return df.withColumn("fields", F.from_json(self.col, "map<string,string>")).drop(self.col)
        return df.withColumn("vector", F.col(self.col).cast("array<double>")).drop(self.col)

    def fit(self, train: DataFrame) -> None:
        if self.kind == "tabular" and not self.given:
            found = train.select(F.explode_outer(F.map_keys("fields")).alias("k")).filter("k IS NOT NULL").distinct().limit(WIDE + 1).count()
            self.dictionary = key_dictionary(train) if found > WIDE else None
            if self.dictionary is not None:
                self.keys, self.mean, self.std = None, [], []
                return
            self.keys = map_keys(train, F.col("fields"), WIDE)
        row = scale_stats(self._numbers(train), "vector").first()
        self.mean, self.std = list(row["mean"] or []), list(row["std"] or [])

    def _numbers(self, prepared: DataFrame) -> DataFrame:
        if self.kind != "tabular":
            return prepared
        return prepared.withColumn("vector", field_values(F.col("fields"), self.keys or [])).drop("fields")

    def vectors(self, prepared: DataFrame) -> DataFrame:
        return self.attach(prepared) if self.in_vectors else as_vectors(self.attach(prepared))

    def attach(self, prepared: DataFrame) -> DataFrame:
        """Replace the numbers by ``features``; rows are not moved, unless they are wide."""
        if self.dictionary is not None:
            return wide_rows(prepared, self.dictionary)
        stats = prepared.sparkSession.createDataFrame([(self.mean, self.std)], "mean array<double>, std array<double>")
        scaled = standard_scale(self._numbers(prepared), "vector", stats)
        return scaled.withColumn("features", array_to_vector("scaled")).drop("scaled", "vector")


def features_for(df: DataFrame, modality: str, mode: str = "tfidf", embedding_col: str = "embedding", max_features: int = MAX_FEATURES):
    """The extractor for a modality; anything unknown is treated as text."""
    if modality == "tabular":
        return DenseFeatures("text", tabular=True)
    if embedding_col in df.columns and (modality in ("image", "audio") or mode in ("sentence", "embedding")):
        return DenseFeatures(embedding_col)
    return TermFeatures(max_features)
