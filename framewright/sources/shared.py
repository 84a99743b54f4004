"""The folder that a cluster's driver and executors share: lineage cuts and written tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where none is configured and all runs in one process, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='framewright-')}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of written tables that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
