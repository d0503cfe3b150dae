"""Aligning modalities on an id or on time, and describing the result."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.stats import percent


def align_by_id(modalities: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Full outer alignment of all tables on ``key`` with a single shuffle; nothing is dropped.

    Columns are prefixed with the modality name and ``has_<modality>`` flags tell what is
    present.  A table must hold one row per key (see ``one_per_key``); a repeated key
    raises instead of multiplying or losing rows.  Rows without a key stay on their own.
    """
    packed = []
    for name, df in modalities.items():
        cells = F.struct(F.lit(True).alias("_here"), *[c for c in df.columns if c != key])
        solo = F.when(F.col(key).isNull(), F.concat(F.lit(name), F.monotonically_increasing_id().cast("string")))
        packed.append(df.select(key, solo.alias("_solo"), cells.alias(name)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    one = [F.first(name, ignorenulls=True).alias(name) for name in modalities]
    counts = [F.count(name).alias(f"_n_{name}") for name in modalities]
    rows = union.groupBy(key, "_solo").agg(*one, *counts)
    columns, flags = [F.col(key)], []
    for name, df in modalities.items():
        repeated = F.raise_error(F.concat(F.lit(f"several rows of {name} for key "), F.col(key).cast("string")))
        cell = F.when(F.col(f"_n_{name}") > 1, repeated.cast(rows.schema[name].dataType)).otherwise(F.col(name))
        columns += [cell[c].alias(f"{name}_{c}") for c in df.columns if c != key]
        flags.append((F.col(f"_n_{name}") > 0).alias(f"has_{name}"))
    return rows.select(*columns, *flags)


def one_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row per key by ``order`` (unique within the key), combined map-side."""
    rest = [c for c in df.columns if c not in (key, order)]
    first = df.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_r"))
    return first.select(key, "_r.*")


def align_asof(
    left: DataFrame,
    right: DataFrame,
    by: str,
    ts: str,
    tolerance_seconds: float | None = None,
    right_id: str = "id",
    levels: tuple[int, ...] = (60, 86_400),
) -> DataFrame:
    """For each left row the last right row of the same ``by`` at or before its time.

    Unmatched left rows stay, with NULL ``right_id`` and ``right_ts``; on equal times the
    largest right id wins.  Times are compared in microseconds.

    A hot key is split by time: distinct times are ranked inside (key, minute), and only
    the last match of each minute travels on, first inside its day, then over the days.
    No task ever holds all rows of a key, whatever its share of the data.
    """
    micros = _micros(left, ts)
    l_times = left.select(F.col(by).alias("_k"), micros.alias("_t")).distinct().withColumn("_r", F.lit(None).cast("bigint"))
    r_times = right.groupBy(F.col(by).alias("_k"), _micros(right, ts).alias("_t")).agg(F.max(right_id).cast("bigint").alias("_r"))
    points = l_times.unionByName(r_times).groupBy("_k", "_t").agg(F.max("_r").alias("_r"))
    points = points.withColumn("_hit", F.when(F.col("_r").isNotNull(), F.struct("_t", "_r"))).select("_k", "_t", "_hit")
    filled = _carry_forward(points, levels).withColumnRenamed("_k", "_ak").withColumnRenamed("_t", "_at")
    matched = left.withColumn("_lt", micros).join(
        filled, F.col(by).eqNullSafe(F.col("_ak")) & (F.col("_lt") == F.col("_at")), "left"
    )
    hit = F.col("_hit")
    if tolerance_seconds is not None:
        near = F.col("_lt") - hit["_t"] <= int(tolerance_seconds * 1_000_000)
        hit = F.when(near, hit)
    # rows without a key or time never match
    usable = F.col(by).isNotNull() & F.col("_lt").isNotNull()
    return matched.select(
        *left.columns,
        F.when(usable, hit["_r"]).alias("right_id"),
        F.when(usable, _timestamp(left, ts, hit["_t"])).alias("right_ts"),
    )


def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970; zone-free timestamps never pass through a time zone."""
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    return F.unix_micros(ts)


def _timestamp(df: DataFrame, ts: str, micros: Column) -> Column:
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.timestamp_micros(micros)


def _carry_forward(points: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Fill ``_hit`` with the latest non-null one at or before each (_k, _t)."""
    if not levels:
        upto = W.partitionBy("_k").orderBy("_t").rowsBetween(W.unboundedPreceding, 0)
        return points.withColumn("_hit", F.last("_hit", ignorenulls=True).over(upto))
    width = levels[0] * 1_000_000
    cut = points.withColumn("_b", F.col("_t") - F.pmod(F.col("_t"), F.lit(width)))
    upto = W.partitionBy("_k", "_b").orderBy("_t").rowsBetween(W.unboundedPreceding, 0)
    local = cut.withColumn("_hit", F.last("_hit", ignorenulls=True).over(upto))
    # each bucket asks at its own start and answers at its end, which is the next start
    ends = cut.groupBy("_k", "_b").agg(F.max("_hit").alias("_hit"))
    asks = ends.select("_k", F.col("_b").alias("_t"), F.when(F.lit(False), F.col("_hit")).alias("_hit"))
    answers = ends.select("_k", (F.col("_b") + width).alias("_t"), "_hit")
    chain = _carry_forward(asks.unionByName(answers).groupBy("_k", "_t").agg(F.max("_hit").alias("_hit")), levels[1:])
    chain = chain.select(F.col("_k").alias("_ck"), F.col("_t").alias("_cb"), F.col("_hit").alias("_carry"))
    joined = local.join(chain, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left")
    return joined.select("_k", "_t", F.coalesce("_hit", "_carry").alias("_hit"))


def alignment_coverage(aligned: DataFrame, modalities: list[str]) -> DataFrame:
    """Rows with each modality, with each pair, and with all of them."""
    sets = [(m,) for m in modalities] + list(combinations(modalities, 2))
    if len(modalities) > 2:
        sets.append(tuple(modalities))
    total = F.count(F.lit(1))
    rows = []
    for names in sets:
        present = reduce(lambda a, b: a & b, [F.col(f"has_{m}") for m in names])
        n = F.count_if(present)
        rows.append(F.struct(F.lit("+".join(names)).alias("modalities"), n.alias("n"), percent(n, total).alias("pct")))
    return aligned.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def joint_label_distribution(aligned: DataFrame, label_a: str, label_b: str) -> DataFrame:
    pairs = aligned.filter(F.col(label_a).isNotNull() & F.col(label_b).isNotNull())
    return pairs.groupBy(F.col(label_a).cast("string").alias("label_a"), F.col(label_b).cast("string").alias("label_b")).agg(F.count(F.lit(1)).alias("n"))


def pair_examples(aligned: DataFrame, modalities: list[str], key: str = "id") -> DataFrame:
    """The row with the smallest key for every pair of modalities."""
    pairs = list(combinations(modalities, 2))
    ids = aligned.agg(*[F.min(F.when(F.col(f"has_{a}") & F.col(f"has_{b}"), F.col(key))).alias(f"{a}+{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(f"{a}+{b}").alias("pair"), F.col(f"{a}+{b}").alias(key)) for a, b in pairs])
    # one row per pair of modalities
    found = ids.select(F.explode(rows).alias("r")).select("r.*").filter(F.col(key).isNotNull())
    return aligned.join(F.broadcast(found), key).select("pair", *aligned.columns)
