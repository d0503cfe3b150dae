"""Bringing sources into the unified table, and small text/URL extractions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.joins import SHARE
from siltworks.functions.markup import visible_text
from siltworks.functions.membership import mark_members
from siltworks.functions.scratch import materialize
from siltworks.functions.stats import stored_groups
from siltworks.functions.text import fingerprint, is_blank
from siltworks.schema import MODALITIES, UNLABELED

# URL fragment -> site name, tried in this order.
SITE_RULES = (
    ("kaggle.com", "Kaggle"),
    ("paperswithcode.com", "PapersWithCode"),
    ("github.com", "GitHub"),
    ("huggingface.co", "HuggingFace"),
    ("openml.org", "OpenML"),
    ("uci.edu", "UCI"),
)
DEFAULT_SITE = "Web"


def unify(
    df: DataFrame,
    text_col: str,
    label_col: str | None = None,
    modality: str = "text",
    source: str | Column = "local:table",
    collected_at: str | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Project any table to the unified schema; NULL and blank texts are dropped."""
    if modality not in MODALITIES:
        raise ValueError(f"unknown modality {modality!r}")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX") if collected_at is None else F.lit(collected_at)
    label = F.lit(UNLABELED) if label_col is None else F.coalesce(F.col(label_col).cast("string"), F.lit(UNLABELED))
    return filter_blank(
        df.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(text_col).cast("string").alias("text"),
            label.alias("label"),
            F.lit(modality).alias("modality"),
            (source if isinstance(source, Column) else F.lit(source)).alias("source"),
            stamp.alias("collected_at"),
        )
    )


def filter_blank(df: DataFrame, col: str = "text") -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~is_blank(F.col(col)))


REPEATED_LIMIT = 500_000


def keep_winners(df: DataFrame, groups: DataFrame, key: str, on: list[str], limit: int = REPEATED_LIMIT) -> DataFrame:
    """The rows of ``df`` that won their group; ``on`` identifies a row.

    ``groups`` is a stored table (fp, n, *on) with the winner of every key in ``df``.
    A row stays when its key has no copies, or when it agrees with the winner in every
    column of ``on``, NULLs included.  ``limit`` only chooses the plan: so many
    winners (counted, some 50 bytes each) are broadcast and whole rows stay where they
    are.  With more of them, the winners of hot keys (one row in ``SHARE`` or more, so at
    most ``SHARE`` keys) are still broadcast, rows whose key is not in a filter of the other repeated
    ones stay in place too, and what is left is shuffled: rows of keys that each hold less
    than that share.
    """
    repeated = groups.filter("n > 1")
    n_repeated = repeated.count()
    named = F.coalesce("fp", F.lit(b"")).alias("_fp")
    winners = repeated.select(named, F.struct(*on).alias("_win"), "n")
    keyed = df.withColumn("_fp", F.coalesce(fingerprint(F.col(key)), F.lit(b"")))
    wins = F.col("_win").isNull() | F.col("_win").eqNullSafe(F.struct(*on))
    if n_repeated <= limit:
        return keyed.join(F.broadcast(winners.drop("n")), "_fp", "left").filter(wins).select(*df.columns)
    total = groups.agg(F.sum("n")).first()[0]
    hot = winners.filter(F.col("n") * SHARE >= total).drop("n")
    cold = winners.filter(F.col("n") * SHARE < total).drop("n")
    met = keyed.join(F.broadcast(hot), "_fp", "left")
    marked = mark_members(met, cold.select("_fp"), "_fp", n_repeated, "_maybe")
    moves = F.col("_maybe") & F.col("_win").isNull()
    still = marked.filter(~moves).filter(wins).select(*df.columns)
    moved = marked.filter(moves).drop("_win", "_maybe").join(cold, "_fp", "left").filter(wins).select(*df.columns)
    return still.unionByName(moved)


def keep_first(df: DataFrame, groups: DataFrame, key: str, order: str, limit: int = REPEATED_LIMIT) -> DataFrame:
    """``keep_winners`` for stored text groups, whose winner is the first id."""
    return keep_winners(df, groups.withColumnRenamed("first_id", order), key, [order], limit)


def dedupe_first(df: DataFrame, key: str = "text", order: str = "id") -> DataFrame:
    """Keep the row with the smallest ``order`` for every distinct ``key``.

    ``order`` must be unique.  Only (hash, order) is grouped, so copies of a hot text
    collapse before the shuffle.
    """
    return keep_first(df, stored_groups(df, key, order), key, order)


def combine_sources(dfs: list[DataFrame], key: str = "text", id: str = "id") -> DataFrame:
    """Union all sources, then keep the first copy of every text.

    "First" is the earliest source in the list, then the smallest id.  New ids
    (``id * k + position``) keep rows of different sources apart; where that leaves 64
    bits, as with hashed ids, the new id is a hash of source position and id.
    """
    k = len(dfs)
    placed = [df.withColumn("_pos", F.lit(i)) for i, df in enumerate(dfs)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)
    first = (
        union.select(fingerprint(F.col(key)).alias("fp"), F.struct("_pos", id).alias("_at"))
        .groupBy("fp")
        .agg(F.min("_at").alias("_at"), F.count(F.lit(1)).alias("n"))
        .select("fp", "n", F.col(f"_at.{id}").alias(id), F.col("_at._pos").alias("_pos"))
    )
    kept = keep_winners(union, materialize(first, "text-groups"), key, [id, "_pos"])
    spaced = F.try_add(F.try_multiply(F.col(id), F.lit(k)), F.col("_pos").cast("long"))
    hashed = F.when(F.col(id).isNotNull(), F.xxhash64("_pos", id))
    return kept.withColumn(id, F.coalesce(spaced, hashed)).drop("_pos")


def source_kind(df: DataFrame, col: str = "source") -> DataFrame:
    kind = F.substring_index(col, ":", 1)
    return df.filter(F.col(col).isNotNull()).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def classify_host(df: DataFrame, url_col: str = "url", rules=SITE_RULES, default: str = DEFAULT_SITE) -> DataFrame:
    """Add ``site``: the first rule whose fragment occurs in the lower-cased URL."""
    lowered = F.lower(F.col(url_col))
    site = F.lit(default)
    for fragment, name in reversed(list(rules)):
        site = F.when(lowered.contains(fragment), F.lit(name)).otherwise(site)
    return df.withColumn("site", site)


def parse_project_url(df: DataFrame, url_col: str, pattern: str, names=("workspace", "project")) -> DataFrame:
    """Add one column per regex group; NULL where the URL does not match from its start."""
    anchored = "^(?:" + pattern + ")"
    for i, name in enumerate(names, 1):
        df = df.withColumn(name, F.nullif(F.regexp_extract(url_col, anchored, i), F.lit("")))
    return df


def dedupe_hits(df: DataFrame, key: list[str], order: str, limit: int) -> DataFrame:
    """First hit per key in rank order, then the best ``limit`` of those."""
    rest = [c for c in df.columns if c not in key and c != order]
    best = df.groupBy(*key).agg(F.min(F.struct(order, *rest)).alias("_hit"))
    return best.select(*key, "_hit.*").orderBy(order, *key).limit(limit)


def catalog_tags(df: DataFrame, tags: str = "tags") -> DataFrame:
    """First tag of each prefix without the prefix, with defaults; NULL counters -> 0."""

    def first(prefix: str, default: str) -> Column:
        hit = F.get(F.filter(tags, lambda t: t.startswith(prefix)), F.lit(0))
        return F.coalesce(F.replace(hit, F.lit(prefix), F.lit("")), F.lit(default))

    out = (
        df.withColumn("size", first("size_categories:", "?"))
        .withColumn("task", first("task_categories:", "?"))
        .withColumn("modality", first("modality:", "text"))
        .drop(tags)
    )
    for counter in ("downloads", "likes"):
        if counter in out.columns:
            out = out.withColumn(counter, F.coalesce(counter, F.lit(0)))
    return out


def catalog_top(df: DataFrame, by: str, n: int, id: str = "id", size_bytes: str = "bytes") -> DataFrame:
    """Top-n catalog rows by a counter; adds the size in MB when bytes are known."""
    if size_bytes in df.columns:
        df = df.withColumn("size_mb", F.round(F.col(size_bytes) / 1e6, 1))
    return df.orderBy(F.col(by).desc_nulls_last(), id).limit(n)


def html_to_text(df: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "id", collected_at: str | None = None) -> DataFrame:
    """Stored pages to unified rows with a ``scrape:<url>`` source.

    The text passes through a one-element array: a filter on a generated column is not
    pushed down, so the markup is stripped once, not again for the blank test.
    """
    text = F.explode_outer(F.array(visible_text(F.col(html_col))))
    pages = df.select(F.col(id_col).alias("id"), text.alias("text"), F.concat(F.lit("scrape:"), F.col(url_col)).alias("src"))
    return unify(pages, "text", source=F.col("src"), collected_at=collected_at)


def preview_text(df: DataFrame, n: int = 300, col: str = "text") -> DataFrame:
    """Add a display excerpt of ``n`` characters next to the full length."""
    return df.withColumn("preview", F.substring(col, 1, n)).withColumn("length", F.length(col))


def row_json(df: DataFrame) -> DataFrame:
    """Every row as one JSON object of strings; NULL fields are kept."""
    fields = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return df.withColumn("row_json", F.to_json(fields, {"ignoreNullFields": "false"}))
