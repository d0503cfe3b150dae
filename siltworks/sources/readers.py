"""Readers.  Each returns a lazy DataFrame; schemas are declared, not inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.schema import HISTORY, MODALITIES, REVIEWED, UNIFIED, UNLABELED


def read_examples(spark: SparkSession, path: str, schema: T.StructType | None = UNIFIED) -> DataFrame:
    """Parquet scan of an example table; columns absent from a file read as NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread_small(df: DataFrame, path: str, max_bytes: int = 1 << 30) -> DataFrame:
    """Spread the rows of a small table that sits in fewer files than there are cores.

    One file with one row group is one task, however many cores wait.  Only sizes from
    the file listing are read; a table that is larger or already split stays as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = listing.agg(F.count("path").alias("files"), F.sum("length").alias("bytes")).first()
    small = found["files"] < cores and (found["bytes"] or 0) <= max_bytes
    return df.repartition(cores) if small else df


def spread_even(df: DataFrame) -> DataFrame:
    """Deal rows out in parts of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    The number of parts follows the measured size, so neither a task nor a file grows with the table.
    """
    return df.hint("rebalance")


def read_many(spark: SparkSession, *paths: str, schema: T.StructType | None = UNIFIED) -> DataFrame:
    """Read and union every table under the given paths or globs.

    With the declared schema no footer merging is needed; ``schema=None`` merges the
    files' own schemas instead.
    """
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(*paths)
    return spark.read.schema(schema).parquet(*paths)


def read_examples_csv(spark: SparkSession, path: str, schema: T.StructType = REVIEWED, multi_line: bool = True) -> DataFrame:
    """CSV with a header; columns are matched by header name, a BOM is skipped.

    ``multi_line`` allows quoted newlines, at the price of one task per file; write
    many files (as ``write_csv`` does) so that this stays parallel.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("nullValue", "\u0001")  # an unquoted empty field is NULL, a quoted one is ''
        .option("emptyValue", "")
        .option("encoding", "UTF-8")
        .csv(path)
    )
    wanted = [f for f in schema.fields if f.name in raw.columns]
    extra = [c for c in raw.columns if c not in schema.fieldNames()]
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted], *extra)


def read_history(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON arrays of cycle records; the file name supplies a missing strategy."""
    named = F.regexp_extract(F.col("_metadata.file_name"), r"history_([A-Za-z0-9]+)", 1)
    return (
        spark.read.schema(HISTORY)
        .option("multiLine", True)
        .json(list(paths))
        .withColumn("strategy", F.coalesce("strategy", F.nullif(named, F.lit(""))))
    )


def literal_examples(spark: SparkSession, texts: list[str]) -> DataFrame:
    """A small table from literal texts, for one-off predictions."""
    rows = [(i, text, UNLABELED, "text", "literal", None) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, UNIFIED)


def load_modality(spark: SparkSession, path: str, modality: str, source: str | None = None) -> DataFrame:
    """Typed loader: image and audio folders by path, tables by file type."""
    from siltworks.sources.images import scan_files, scan_image_dir

    if modality not in MODALITIES:
        raise ValueError(f"unknown modality {modality!r}; use one of {MODALITIES}")
    if path.endswith(".csv"):
        loaded = read_examples_csv(spark, path)
    elif path.endswith(".json"):
        loaded = spark.read.schema(UNIFIED).json(path)
    elif modality == "image" and not path.endswith(".parquet"):
        return scan_image_dir(spark, path, source or "local:images")
    elif modality == "audio" and not path.endswith(".parquet"):
        return scan_files(spark, path, "*.{wav,mp3,flac,ogg,m4a}", "audio", source or "local:audio")
    else:
        loaded = read_examples(spark, path)
    return loaded.withColumn("modality", F.lit(modality))
