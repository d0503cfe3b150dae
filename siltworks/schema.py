"""Schemas, sentinel values and the few fixed constants shared by every module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the data model.
UNLABELED = "unlabeled"
UNKNOWN = "unknown"
TEXT_LABEL_SOURCE = ("label", "source", "collected_at")
MODALITIES = ("text", "image", "audio", "tabular")
REVIEW_THRESHOLD = 0.75

UNIFIED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("collected_at", T.StringType()),
    ]
)
LABELED = T.StructType(UNIFIED.fields + [T.StructField("confidence", T.DoubleType())])
REVIEWED = T.StructType(LABELED.fields + [T.StructField("corrected_label", T.StringType())])
HISTORY = T.StructType(
    [
        T.StructField("iteration", T.IntegerType()),
        T.StructField("n_labeled", T.LongType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("model", T.StringType()),
    ]
)

_NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def has(df: DataFrame, *names: str) -> bool:
    """True when every named column exists (resolved while planning, no job)."""
    return all(name in df.columns for name in names)


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ("id",)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in skip]
