"""Stored intermediate tables, row hashes and running offsets shared by the operators here."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.functions.scratch import new_path


def sweep_shuffles(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark deletes shuffle files nothing needs any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def store(df: DataFrame, name: str, sweep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends here, so shuffle files of the jobs before it are no longer needed.
    ``sweep``, for jobs that shuffled texts, has them deleted at once.
    """
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    if sweep:
        sweep_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for parent in {file.rpartition("/")[0] for file in table.inputFiles()}:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
            target.getFileSystem(conf).delete(target, True)


def digest(*columns: Column | str) -> list[Column]:
    """Two 64-bit hashes with different seeds: a 128-bit identity for exact grouping."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(7), *columns, F.lit("x")).alias("h2")]


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column is called that (names ignore case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, also with dots or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns called c0, c1, ... and the new name of each.

    Operators that add columns of their own work on it, so that no name clashes.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def running_offsets(counts: DataFrame, part: str, item: str, size: str) -> DataFrame:
    """Add ``before``: the sum of ``size`` over all earlier (part, item) pairs.

    Items are summed inside their part and only parts are ordered globally, so no task
    gets more rows than one part has items or than there are parts.
    """
    parts = counts.groupBy(part).agg(F.sum(size).alias("_total"))
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    bases = parts.select(part, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    inside = W.partitionBy(part).orderBy(item).rowsBetween(W.unboundedPreceding, -1)
    local = counts.withColumn("_local", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return local.join(bases, part).withColumn("before", (F.col("_base") + F.col("_local")).cast("long")).drop("_base", "_local")
