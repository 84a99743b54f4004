"""Registry of the library's own queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framewright.plans import boxes, clips, manifests, pairs, tracks  # noqa: F401 (registered on import)
from framewright.plans.registry import QUERIES, SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips.shard_balance(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
