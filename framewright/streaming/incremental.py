"""Incremental runs: new files are a stream, finished samples are skipped, results are keyed upserts.

`run_once` reads what has arrived since the last run (availableNow), hands each batch's
pending rows to the stage and merges the outcome into the manifest. The checkpoint
remembers the files, the markers remember the samples, so a killed run resumes and a
repeated one does nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.operators.select import last_wins, pending


def run_once(spark: SparkSession, source: str, schema: str, stage: Callable[[DataFrame], DataFrame], manifest: str, checkpoint: str, key: str = "sample_id") -> None:
    """stage: rows -> rows with key and status. The manifest is a folder of versions, each the rows of one batch and complete when that is; a batch costs what it brings, not what was there before."""

    def merge(batch: DataFrame, number: int) -> None:
        before = latest(spark, manifest, key)
        todo = batch if before is None else pending(batch, before, key)
        stage(todo).withColumn("__order", F.lit(number)).write.mode("overwrite").parquet(f"{manifest}/version={number:012d}")

    stream = spark.readStream.schema(schema).json(source)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, manifest: str, key: str = "sample_id") -> DataFrame | None:
    """The newest row of each key over all complete versions, or None if there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    done = [s.getPath().toString() for s in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(manifest, "version=*/_SUCCESS"))]
    return last_wins(spark.read.parquet(*(p.removesuffix("/_SUCCESS") for p in done)), key, ["__order"]) if done else None
