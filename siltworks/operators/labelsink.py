"""Labeling into a folder, batch by batch, so that an interrupted run can go on.

Layout under the folder, all of it Parquet:

* ``todo/generation=g/batch=b`` - the unlabeled rows, cut into batches by a hash of their id
  when they were first seen; rows that arrive later form another generation.
* ``labels/batch=b`` - the labeled rows of a batch.
* ``log`` - one row per finished step: ``(kind, number, first, count)``, appended as the last act of
  the step.  A generation or batch without its row does not count, is written again
  by the next run and replaces what was left.

So a run that ends anywhere loses at most the batch it was in, and no finished row
goes to the labeler twice.  Rows are told apart by id; all rows without one belong to one
generation.  One run at a time may write to a folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.joins import join_small
from siltworks.operators.annotate import Labeler, auto_label, resume_labeling, split_unlabeled
from siltworks.schema import UNLABELED, has

LOG = "kind string, number int, first int, count int"
BATCH_ROWS = 100_000


class LabelSink:
    """The labels of a table under ``path``."""

    def __init__(self, spark: SparkSession, path: str, id: str = "id"):
        self.spark, self.path, self.id = spark, path.rstrip("/"), id
        self._note([])  # the log can be read from now on

    def _note(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _log(self, kind: str) -> dict[int, tuple[int, int]]:
        """Finished steps; one small row per batch or generation reaches the driver."""
        rows = self.spark.read.schema(LOG).parquet(f"{self.path}/log").filter(F.col("kind") == kind).collect()
        return {r["number"]: (r["first"], r["count"]) for r in rows}

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def plan(self, todo: DataFrame, batch_rows: int = BATCH_ROWS) -> list[tuple[int, int]]:
        """File the rows not seen before into batches of about ``batch_rows``; returns all (generation, batch)."""
        known, fresh = self._log("generation"), todo
        if known:
            # who is new is found on ids alone, so texts only move if very many rows are
            seen = [self._read(f"todo/generation={g}", todo.select(self.id).schema) for g in known]
            new = resume_labeling(todo.select(self.id), reduce(DataFrame.unionByName, seen), self.id).distinct()
            fresh = join_small(todo, new.withColumnRenamed(self.id, "_new"), F.col(self.id).eqNullSafe(F.col("_new")), "left_semi")
        size = fresh.count()
        if size:
            g, first = len(known), sum(count for _, count in known.values())
            count = -(-size // batch_rows)
            cut = fresh.withColumn("batch", (F.pmod(F.xxhash64(F.col(self.id).cast("string"), F.lit(g)), F.lit(count)) + first).cast("int"))
            cut.write.mode("overwrite").partitionBy("batch").parquet(f"{self.path}/todo/generation={g}")
            self._note([("generation", g, first, count)])
            known[g] = (first, count)
        return [(g, b) for g, (first, count) in sorted(known.items()) for b in range(first, first + count)]

    def append(
        self,
        df: DataFrame,
        classes: list[str],
        labeler: Labeler | dict[str, Labeler] | None = None,
        rules: dict[str, str] | None = None,
        batch_rows: int = BATCH_ROWS,
        batch_size: int = 10,
        most_batches: int | None = None,
    ) -> int:
        """Label the unlabeled rows of ``df`` that have no label here yet; returns the batches finished by this call.

        ``labeler``, ``rules`` and ``batch_size`` are those of ``auto_label``; ``most_batches`` ends the call early.
        """
        todo = split_unlabeled(df)[0]
        if not has(todo, "label"):
            todo = todo.withColumn("label", F.lit(UNLABELED))
        done = self._log("batch")
        waiting = [(g, b) for g, b in self.plan(todo, batch_rows) if b not in done][:most_batches]
        for g, b in waiting:
            schema = T.StructType([*todo.schema.fields, T.StructField("batch", T.IntegerType())])
            rows = self._read(f"todo/generation={g}", schema).filter(F.col("batch") == b).drop("batch")
            tasks = self.spark.sparkContext.defaultParallelism
            spread = rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks)
            out = auto_label(spread, classes, labeler, rules, batch_size)
            out.write.mode("overwrite").parquet(f"{self.path}/labels/batch={b}")
            self._note([("batch", b, b, 1)])
        return len(waiting)

    def labels(self, schema: T.StructType) -> DataFrame:
        """All labeled rows of finished batches; ``schema`` is that of the labeled table."""
        finished = self.spark.read.schema(LOG).parquet(f"{self.path}/log").filter("kind = 'batch'").select(F.col("number").alias("batch")).distinct()
        if not self._log("batch"):
            return self.spark.createDataFrame([], schema)
        whole = self._read("labels", T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())]))
        return whole.join(F.broadcast(finished), "batch").select(*schema.fieldNames())

    def table(self, df: DataFrame) -> DataFrame:
        """``df`` as ``auto_label`` would return it: rows labeled before, and those with a label from here."""
        done = split_unlabeled(df)[1]
        base = done.drop("confidence").withColumn("confidence", done["confidence"].cast("double") if has(df, "confidence") else F.lit(None).cast("double"))
        return base.unionByName(self.labels(base.schema))
