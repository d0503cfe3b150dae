"""Media folders as example rows, and file bytes as data URIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.schema import UNLABELED

# Folder names, file extensions (case-sensitive) and MIME types.
SPLITS = ("train", "valid", "test")
EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp")
MIME = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "webp": "image/webp", "gif": "image/gif"}
DEFAULT_MIME = "image/jpeg"


def _rows(paths: DataFrame, path: str, modality: str, source: str, collected_at: str | None) -> DataFrame:
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX") if collected_at is None else F.lit(collected_at)
    return paths.select(
        F.xxhash64(path).alias("id"),
        F.col(path).alias("text"),
        F.lit(UNLABELED).alias("label"),
        F.lit(modality).alias("modality"),
        F.lit(source).alias("source"),
        stamp.alias("collected_at"),
    )


def image_rows(paths: DataFrame, source: str, path: str = "path", collected_at: str | None = None) -> DataFrame:
    """Image examples from a listing of file paths.

    A split folder counts its ``images`` subfolder when it has one, else its own
    files.  The three possible flags are gathered as one row.
    """
    part = F.regexp_extract(path, rf"/({'|'.join(SPLITS)})/(?:images/)?[^/]+$", 1)
    nested = F.col(path).rlike(rf"/({'|'.join(SPLITS)})/images/[^/]+$")
    listed = paths.select(path, part.alias("_split"), nested.alias("_nested")).filter("_split <> ''")
    with_images = listed.filter("_nested").agg(F.collect_set("_split")).scalar()
    suffix = F.substring_index(path, ".", -1)
    chosen = listed.filter(
        suffix.isin(*EXTENSIONS) & F.col(path).contains(".") & (F.col("_nested") | ~F.array_contains(with_images, F.col("_split")))
    )
    return _rows(chosen, path, "image", source, collected_at)


def _local_path(path: Column) -> Column:
    """Drop a file: scheme so that local listings give absolute paths."""
    return F.regexp_replace(path, r"^file:(//)?(?=/)", "")


def _folders(spark: SparkSession, root: str) -> list[str]:
    """The folders that a path, URI or glob stands for, without scheme and host."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(path) or []
    return [system.makeQualified(status.getPath()).toUri().getPath().rstrip("/") for status in found]


def scan_image_dir(spark: SparkSession, root: str, source: str, collected_at: str | None = None) -> DataFrame:
    """List an image folder given as a path, URI or glob; only paths are read, never the file bytes."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    plain = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "")
    inside = F.lit(False)
    for folder in _folders(spark, root):
        rest = F.substr(plain, F.lit(len(folder) + 1))
        inside = inside | (plain.startswith(folder) & rest.rlike(rf"^/({'|'.join(SPLITS)})/(images/)?[^/]+$"))
    listed = listing.filter(inside).select(_local_path(F.col("path")).alias("path"))
    return image_rows(listed, source, collected_at=collected_at)


def scan_files(spark: SparkSession, root: str, pattern: str, modality: str, source: str, collected_at: str | None = None) -> DataFrame:
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return _rows(listing.select(_local_path(F.col("path")).alias("path")), "path", modality, source, collected_at)


def image_data_uri(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Add ``mime`` and ``data_uri`` built from the file bytes."""
    suffix = F.lower(F.when(F.col(path).rlike(r"\.[^./]*$"), F.substring_index(path, ".", -1)).otherwise(""))
    mime = F.lit(DEFAULT_MIME)
    for extension, kind in MIME.items():
        mime = F.when(suffix == extension, F.lit(kind)).otherwise(mime)
    body = F.translate(F.base64(content), "\r\n", "")
    return df.withColumn("mime", mime).withColumn("data_uri", F.concat(F.lit("data:"), F.col("mime"), F.lit(";base64,"), body))
