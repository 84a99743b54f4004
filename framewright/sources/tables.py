"""Annotation, record and audit tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ANNOTATIONS = "video_id string, video_caption string, cross_pair string"
RECORDS = "vid string, youtube_url string, timestamp string, width int, height int, fps double"
AUDIT = "video string, ext string, size string, last_modified_utc string, key string"


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Three columns only; the scan reads no others."""
    return spark.read.parquet(path).select("video_id", "video_caption", "cross_pair")


def records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("vid", F.col("youtube_url").alias("url"), "timestamp", "width", "height", "fps")


def audit(spark: SparkSession, path: str) -> DataFrame:
    """Columns by position, header skipped, an empty extension stays empty text."""
    rows = spark.read.schema(AUDIT).option("header", True).option("enforceSchema", True).csv(path)
    return rows.select("video", F.coalesce("ext", F.lit("")).alias("ext"))
