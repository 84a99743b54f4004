"""Candidate boxes of a subject's two sides: detector picks, part filter, greedy dedupe, best pair with its margin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.functions.geometry import Box, iou, is_plausible
from framewright.functions.rounding import round_exact

#: Overlap from which a box repeats another, detector picks a side, and the detector's least score.
SAME_IOU, PICKS, LEAST_SCORE = 0.9, 3, 0.25


def top_scores(found: DataFrame, keys: list[str], order: str, score: str = "score", k: int = 6, least: float = LEAST_SCORE) -> DataFrame:
    """At most k detections of each key from the least score up, best first (equal scores in detector order), with their rank from 0."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(order))
    return found.where(F.col(score) >= least).withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < k)


def pool(annotated: DataFrame, detected: DataFrame, keys: list[str], share: float = 0.30, picks: int = PICKS) -> DataFrame:
    """Annotation boxes first, then each side's detections that are no mere parts of them, in rank order: keys, place, origin, box, score.

    annotated: keys, box (array); detected: keys, rank, box, score.
    """
    own = annotated.select(*keys, F.lit(0).alias("place"), F.lit("annotation").alias("origin"), "box", F.lit(None).cast("double").alias("score"))
    near = detected.where(F.col("rank") < picks).join(annotated.select(*keys, F.col("box").alias("__own")), keys, "left")
    whole = near.where(is_plausible(Box.from_array(F.col("box")), Box.from_array(F.col("__own")), share))
    return own.unionByName(whole.select(*keys, (F.col("rank") + 1).alias("place"), F.lit("detector").alias("origin"), "box", "score"))


def deduped(pools: DataFrame, keys: list[str], order: list[str], threshold: float = SAME_IOU) -> DataFrame:
    """One row per kept candidate: a box that overlaps an earlier kept one joins that one's `also`; a missing box goes.

    A pool has few members by its making (one annotation and a fixed number of picks), so
    it is folded in one array per key.
    """
    member = F.struct(*(F.col(c) for c in order), F.col("origin"), F.col("box"))
    gathered = pools.where(F.col("box").isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(member)).alias("__m"))
    kept = F.aggregate("__m", F.expr("cast(array() as array<struct<first: struct<%s>, also: array<string>>>)" % _fields(pools, order)), lambda a, x: _fold(a, x, threshold))
    out = gathered.select(*keys, F.posexplode(kept).alias("kept_at", "__k"))
    return out.select(*keys, "kept_at", *(F.col(f"__k.first.{c}").alias(c) for c in order), F.col("__k.first.origin").alias("origin"), F.col("__k.first.box").alias("box"), F.col("__k.also").alias("also"))


def _fields(pools: DataFrame, order: list[str]) -> str:
    return ", ".join(f"{c}: {pools.schema[c].dataType.simpleString()}" for c in [*order, "origin", "box"])


def _fold(kept: Column, x: Column, threshold: float) -> Column:
    hits = F.transform(kept, lambda k: F.coalesce(iou(Box.from_array(x["box"]), Box.from_array(k["first"]["box"])) >= threshold, F.lit(False)))
    first = F.array_position(hits, True)
    joined = F.transform(kept, lambda k, i: F.when(i + 1 == first, F.struct(k["first"].alias("first"), F.concat(k["also"], F.array(x["origin"])).alias("also"))).otherwise(k))
    new = F.array(F.struct(x.alias("first"), F.array().cast("array<string>").alias("also")))
    return F.when(first > 0, joined).otherwise(F.concat(kept, new))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; null if either is missing or zero."""
    dot = _dot(a, b)
    norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(norm > 0, dot / norm)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def scored_pairs(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Every pair of a key's two sides with its similarity (six decimals); pairs that cannot be compared are left out. left, right: keys, place, origin, vector."""
    a = left.select(*keys, F.col("place").alias("ref_index"), F.col("origin").alias("ref_origin"), F.col("vector").alias("__a"))
    b = right.select(*keys, F.col("place").alias("seed_index"), F.col("origin").alias("seed_origin"), F.col("vector").alias("__b"))
    out = a.join(b, keys).withColumn("similarity", round_exact(cosine(F.col("__a"), F.col("__b")), 6)).drop("__a", "__b")
    return out.where(F.col("similarity").isNotNull())


def best_pair(pairs: DataFrame, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The winner of each key, its margin over the runner-up (null if unopposed), pairs scored, pool sizes, whether a detector box won. Keys without a comparable pair have nulls and 0 pairs."""
    w = Window.partitionBy(*keys).orderBy(F.col("similarity").desc(), "ref_index", "seed_index")
    ranked = pairs.withColumn("__n", F.row_number().over(w)).withColumn("__next", F.lead("similarity").over(w)).withColumn("pairs_scored", F.count("*").over(Window.partitionBy(*keys)))
    top = ranked.where("__n = 1").select(
        *keys, "ref_index", "seed_index", F.col("similarity").alias("identity"), round_exact(F.col("similarity") - F.col("__next"), 6).alias("margin"), "pairs_scored",
        ((F.col("ref_origin") == "detector") | (F.col("seed_origin") == "detector")).alias("used_detector"),
    )
    sizes = left.groupBy(*keys).agg(F.count("*").alias("ref_candidates")).join(right.groupBy(*keys).agg(F.count("*").alias("seed_candidates")), keys, "full")
    out = sizes.join(top, keys, "left")
    return out.select(
        *keys, "ref_index", "seed_index", "identity", "margin", F.coalesce("pairs_scored", F.lit(0)).alias("pairs_scored"),
        F.coalesce("ref_candidates", F.lit(0)).alias("ref_candidates"), F.coalesce("seed_candidates", F.lit(0)).alias("seed_candidates"), F.coalesce("used_detector", F.lit(False)).alias("used_detector"),
    )
