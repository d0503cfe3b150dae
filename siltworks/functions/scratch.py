"""Shared storage for intermediate tables.

Anything that must outlive an executor is written as a table, never kept only in
executor memory.  The folder comes from ``spark.checkpoint.dir``; where that is unset it
lies in the session's warehouse folder.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

_stored: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith("file:") or "://" not in warehouse
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return warehouse + "/siltworks"


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for ``name``, which ``release`` deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, which also cuts its lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark deletes shuffle files nothing needs any more.

    Left alone it does so when the driver's heap fills, which shuffles of whole texts do not make happen.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_stored(table: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = table.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for parent in {file.rpartition("/")[0] for file in table.inputFiles()}:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
        target.getFileSystem(conf).delete(target, True)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables this session has stored; returns how many.

    DataFrames that still read them must not be used afterwards.
    """
    paths = _stored.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = hadoop(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)
