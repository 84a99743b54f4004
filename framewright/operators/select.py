"""One row per source, shards, accepted prefixes, last-wins lookups, upserts, resuming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions.ids import DEFAULT_SEED, order_key, shard_of, source_of
from framewright.sources.shared import cut


def one_per_source(rows: DataFrame, clip: str = "video_id", ties: Sequence[str] = (), seed: int = DEFAULT_SEED) -> DataFrame:
    """Of each source the row whose clip id has the least seeded hash (then the ties' order), with `source` and `source_key`, the order of sources.

    The rank limit is applied before the shuffle too, so a hot source sends one row a task.
    """
    order = Window.partitionBy("source").orderBy(order_key(F.col(clip), seed), *ties)
    best = rows.withColumn("source", source_of(F.col(clip))).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
    return best.withColumn("source_key", order_key(F.col("source"), seed))


def in_shard(rows: DataFrame, shard: int, shards: int, source: Column | None = None) -> DataFrame:
    """The rows whose source belongs to the shard; all rows if there is one shard only."""
    if shards < 1:
        raise ValueError(f"there must be one shard at least, got {shards}")
    if not 0 <= shard < shards:
        raise ValueError(f"shard must be in [0, {shards}), got {shard}")
    return rows if shards == 1 else rows.where(shard_of(F.col("source") if source is None else source, shards) == shard)


def considered_prefix(outcomes: DataFrame, accepted: Column, key: str, limit: int | None) -> DataFrame:
    """The outcomes that a walk in key order reads until it has accepted `limit` of them; all if it never does. Give it the columns that are wanted only: the outcomes are computed once and kept. Only the limit's keys meet in one place."""
    if limit is None:
        return outcomes
    outcomes = cut(outcomes)
    last = outcomes.where(accepted).select(key).orderBy(key).limit(limit).agg(F.count("*").alias("n"), F.max(key).alias("k")).first()
    return outcomes.where(F.col(key) <= last["k"]) if last["n"] >= limit else outcomes


def last_wins(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of each key the last row in the given order; combined before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return best.select(key, *(F.col(f"__r.{c}").alias(c) for c in rest))


def upsert(key: str, order: str, *layers: DataFrame) -> DataFrame:
    """Rows of later layers replace those of earlier ones with the same key; within a layer the last in order."""
    ranked = None
    for rank, layer in enumerate(layers):
        layer = layer.withColumn("__rank", F.lit(rank))
        ranked = layer if ranked is None else ranked.unionByName(layer)
    return last_wins(ranked, key, ["__rank", order]).drop("__rank")


def manifest_order(merged: DataFrame, specs: DataFrame, key: str, order: str) -> DataFrame:
    """merged with `position`: that of the key among the specs, null (last) for the others."""
    return merged.join(specs.select(key, F.col(order).alias("position")), key, "left")


def pending(rows: DataFrame, markers: DataFrame, key: str, force: bool = False) -> DataFrame:
    """The rows that a resumed run still has to do: those without a marker that ends them (passed or rejected); all if forced."""
    done = markers.where(F.col("status").isin("passed", "rejected")).select(key).distinct()
    return rows if force else rows.join(done, key, "left_anti")
