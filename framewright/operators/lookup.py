"""From clips to stored videos: a clip's own record first, else its source's, then the file's extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.ids import object_key, source_of, url_video_id
from framewright.operators.select import last_wins

#: Root of source videos in the object store.
ROOT = "videos"


def clip_records(meta: DataFrame, order: str = "row_idx") -> tuple[DataFrame, DataFrame]:
    """(vid, own: its video id), (source, shared: the last known video id of the source) of the records vid, url; later rows win."""
    seen = meta.select("vid", url_video_id(F.col("url")).alias("own"), F.col(order).alias("__o"))
    own = last_wins(seen, "vid", ["__o"]).drop("__o")
    shared = last_wins(seen.where("own is not null").select(source_of(F.col("vid")).alias("source"), F.col("own").alias("shared"), "__o"), "source", ["__o"]).drop("__o")
    return own, shared


def extensions(audit: DataFrame, order: str = "row_idx") -> DataFrame:
    """(video, ext) with later rows winning and a missing extension as empty text."""
    return last_wins(audit.select("video", F.coalesce("ext", F.lit("")).alias("ext"), F.col(order).alias("__o")), "video", ["__o"]).drop("__o")


def with_object_key(rows: DataFrame, meta: DataFrame, audit: DataFrame, vid: str = "vid", name: str = "object_key", order: str = "row_idx", root: str = ROOT) -> DataFrame:
    """rows with the key of their clip's video, null where any step finds nothing. The lookups are plain joins, so the planner broadcasts what is small and splits what is hot."""
    own, shared = clip_records(meta, order)
    kinds = extensions(audit, order)
    out = rows.withColumn("__vid", F.col(vid)).withColumn("__source", source_of(F.col(vid)))
    out = out.join(own.select(F.col("vid").alias("__vid"), F.col("own").alias("__own")), "__vid", "left")
    out = out.join(shared.select(F.col("source").alias("__source"), F.col("shared").alias("__shared")), "__source", "left")
    out = out.withColumn("__video", F.coalesce("__own", "__shared"))
    out = out.join(kinds.select(F.col("video").alias("__video"), F.col("ext").alias("__ext")), "__video", "left")
    return out.withColumn(name, object_key(F.col("__video"), F.col("__ext"), root)).drop("__vid", "__source", "__own", "__shared", "__video", "__ext")
