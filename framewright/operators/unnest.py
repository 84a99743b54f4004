"""Annotation JSON: phrase -> target and reference clips, one row or array element per phrase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The annotation text's shape; positions and boxes stay text, as numbers and nesting vary.
PAIRS = (
    "map<string, struct<obj_from_tgt_video: array<struct<vid: string, frame_idx: string, bbox_loc: string, bbox_cls: string>>,"
    " refer_result: array<array<struct<vid: string, frame_idx: string, bbox_loc: string, bbox_cls: string, scores: string>>>>>"
)


def parsed(text: Column) -> Column:
    """All phrases of an annotation's text with their values. Text that is no JSON is an error."""
    return F.map_entries(F.from_json(text, PAIRS, {"mode": "FAILFAST"}))


def entries(pairs: Column) -> Column:
    """The phrases of a column of parsed annotations in their order; a phrase given twice keeps its first place and its last value. Give it a column, not an expression, or the text is parsed for every phrase."""
    keys = F.transform(pairs, lambda x: x["key"])
    firsts = F.filter(pairs, lambda e, i: F.array_position(keys, e["key"]) == i + 1)
    last = F.transform(firsts, lambda e: F.struct(e["key"].alias("key"), F.element_at(F.filter(pairs, lambda x: x["key"] == e["key"]), -1)["value"].alias("value")))
    # only a row that repeats a phrase pays for the search
    single = F.when(F.size(F.array_distinct(keys)) == F.size(pairs), pairs).otherwise(last)
    return F.transform(
        single,
        lambda e: F.struct(
            e["key"].alias("phrase"),
            F.coalesce(e["value"]["obj_from_tgt_video"], F.array().cast("array<struct<vid: string, frame_idx: string, bbox_loc: string, bbox_cls: string>>")).alias("targets"),
            F.coalesce(
                F.flatten(F.filter(e["value"]["refer_result"], lambda g: g.isNotNull())),
                F.array().cast("array<struct<vid: string, frame_idx: string, bbox_loc: string, bbox_cls: string, scores: string>>"),
            ).alias("refs"),
        ),
    )


def malformed(entry: Column, clip: Column) -> Column:
    """Why an entry is unusable, else null: it needs one target, one reference, and the row's own clip as target."""
    n, m = F.size(entry["targets"]), F.size(entry["refs"])
    return F.when((n != 1) | (m != 1), F.format_string("targets=%d,refs=%d", n, m)).when(
        ~F.coalesce(F.get(entry["targets"], F.lit(0))["vid"] == clip, F.lit(False)), F.lit("target_vid_mismatch")
    )


def box_of(text: Column) -> Column:
    """The first innermost list of numbers of a box, however deeply nested."""
    inner = F.regexp_extract(text, r"\[([^\[\]]*)\]", 1)
    return F.transform(F.split(inner, ","), lambda x: F.trim(x).cast("double"))


def by_phrase(rows: DataFrame, clip: str = "video_id", text: str = "cross_pair") -> DataFrame:
    """One row per phrase: the clip's columns, position, phrase, targets, refs, malformed."""
    exploded = rows.withColumn("__p", parsed(F.col(text))).withColumn("__e", entries(F.col("__p"))).select(*(c for c in rows.columns if c != text), F.posexplode_outer("__e").alias("position", "__x")).where("position is not null")
    return exploded.select(
        *(c for c in rows.columns if c != text), "position", F.col("__x.phrase").alias("phrase"), F.col("__x.targets").alias("targets"),
        F.col("__x.refs").alias("refs"), malformed(F.col("__x"), F.col(clip)).alias("malformed"),
    )


def by_clip(phrases: DataFrame) -> DataFrame:
    """One row per target and reference of each phrase of by_phrase, each with its own clip: side, place, vid, frame_idx, bbox_loc."""
    keep = [c for c in phrases.columns if c not in ("targets", "refs", "malformed")]
    sides = [
        phrases.select(*keep, F.lit(side).alias("side"), F.posexplode(column).alias("place", "x")).select(
            *keep, "side", "place", F.col("x.vid").alias("vid"), F.col("x.frame_idx").alias("frame_idx"), F.col("x.bbox_loc").alias("bbox_loc")
        )
        for side, column in (("target", "targets"), ("reference", "refs"))
    ]
    return sides[0].unionByName(sides[1])
