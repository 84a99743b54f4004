"""Strict JSON lines: blank lines are skipped, bad lines are errors, null keys are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, schema: StructType | str, key: str | None = None) -> DataFrame:
    """Rows of a JSON-lines file; a line that is not JSON fails the job, and so does an object without the key."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if key is None:
        return rows
    return rows.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"{path}: a line has no {key}")).cast(rows.schema[key].dataType)))


def read_objects(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSON-lines file of objects; a line that is none, whatever keys it lacks, is an error that names its file and number.

    Lines are numbered by their order within a file, which is read whole by one task each
    (manifests of one run are small); use `read` where numbers are not needed.
    """
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("at", "line"))
    bad = F.raise_error(F.concat("file", F.lit(":"), (F.col("at") + 1).cast("string"), F.lit(": not a JSON object")))
    is_object = F.col("line").rlike(r"^\s*\{") & F.get_json_object("line", "$").isNotNull()
    checked = lines.where(F.trim("line") != "").select(F.when(is_object, F.col("line")).otherwise(bad.cast("string")).alias("line"))
    return checked.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("o")).select("o.*")


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Like read; no rows where the file does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return read(spark, path, schema)


def write(rows: DataFrame, path: str, order: str | None = None, mode: str = "overwrite") -> None:
    """JSON lines with null fields kept; sorted by `order` (then dropped) if given. Files appear on commit only."""
    if order is not None:
        rows = rows.orderBy(order).drop(order)
    rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def write_with_stats(rows: DataFrame, stats: DataFrame, path: str, order: str) -> None:
    """A manifest in its order, and its counts beside it under `path`.stats."""
    write(rows, path, order)
    write(stats.coalesce(1), f"{path}.stats")
