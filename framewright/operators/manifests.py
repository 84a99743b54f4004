"""Row contracts, artifact paths and summaries of manifests."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def required(where: str, *aliases: Column) -> Column:
    """The first alias that has a value; an error naming the field if none has."""
    return F.coalesce(*aliases, F.raise_error(F.lit(f"{where}: required field is missing")))


def box_space(space: Column) -> Column:
    """annotation where absent or empty, else annotation or frame; anything else is an error."""
    own = F.coalesce(F.nullif(space, F.lit("")), F.lit("annotation"))
    return F.when(own.isin("annotation", "frame"), own).otherwise(F.raise_error(F.concat(F.lit("unknown box space: "), own)))


def is_safe_path(path: Column) -> Column:
    """Whether a path names an object below its root: not empty, no trailing slash, not absolute, no .. part."""
    parts = F.split(path, "/")
    return F.coalesce((path != "") & ~path.endswith("/") & ~path.startswith("/") & ~F.array_contains(parts, "..") & (F.size(_parts(path)) > 0), F.lit(False))


def _parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))


def safe_path(path: Column) -> Column:
    return F.when(is_safe_path(path), path).otherwise(F.raise_error(F.concat(F.lit("unsafe relative path: "), F.coalesce(path, F.lit("null")))))


#: Characters of a file name that choose its directory, and the directory of files about the whole dataset.
SHARD_WIDTH, FLAT = 2, "manifests"


def storage_key(path: Column, prefix: str) -> Column:
    """Key of a safe relative path: bare names go under manifests, manifests/... stays, all else gets a directory from its file name."""
    parts = _parts(path)
    name = F.element_at(parts, -1)
    key = (
        F.when(F.size(parts) == 1, F.array(F.lit(FLAT), name))
        .when(F.get(parts, F.lit(0)) == FLAT, parts)
        .otherwise(F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(F.substring(name, 1, SHARD_WIDTH), name)))
    )
    return F.array_join(F.concat(F.array(F.lit(prefix)), key) if prefix else key, "/")


def clip_path(sample: Column) -> Column:
    return F.format_string("clips/%s.mp4", sample)


def reference_path(sample: Column, subject: Column) -> Column:
    return F.format_string("ref_frames/%s_subj%02d.jpg", sample, subject)


def size_summary(rows: DataFrame, size: str, width: str = "width", height: str = "height", flag: str = "flagged", sample: str = "sample_id", named: int = 50) -> DataFrame:
    """One row: rows, total, whole mean and upper median of sizes, flagged rows, and the first `named` flagged samples.

    The median comes from counts by distinct size (combined before the shuffle), of which a
    running sum finds the middle; no list of all sizes is built.
    """
    counts = rows.where(F.col(size).isNotNull()).groupBy(F.col(size).alias("v")).agg(F.count("*").alias("n"))
    parts = counts.withColumn("part", F.floor(F.log2(F.greatest(F.col("v"), F.lit(1)).cast("double")) * 64).cast("int"))
    totals = parts.groupBy("part").agg(F.sum("n").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    running = parts.join(totals.select("part", "before"), "part").withColumn("end", F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("v")))
    base = rows.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes_total"), F.coalesce(F.floor(F.sum(size) / F.count(size)), F.lit(0)).cast("long").alias("bytes_mean"),
        F.count_if(F.col(flag)).alias("flagged"), F.count(size).alias("__k"),
    )
    k = base.first()["__k"]
    middle = running.where(F.col("end") > k // 2).agg(F.coalesce(F.min("v"), F.lit(0))).first()[0]
    names = [r[0] for r in rows.where(F.col(flag)).select(sample).orderBy(sample).limit(named).collect()]
    return base.drop("__k").withColumns({"bytes_median": F.lit(middle).cast("long"), "flagged_samples": F.lit(names).cast("array<string>")})


def resolutions(rows: DataFrame, width: str = "width", height: str = "height") -> DataFrame:
    return rows.groupBy(F.concat(F.col(width).cast("string"), F.lit("x"), F.col(height).cast("string")).alias("resolution")).agg(F.count("*").alias("n"))


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    """How many samples passed, were rejected, failed or were skipped."""
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def split_heavy(rows: DataFrame, key: str, heavy: list[str]) -> tuple[DataFrame, DataFrame]:
    """The slim rows of a manifest, and the documents that hold its heavy columns, by key; both from one plan."""
    return rows.drop(*heavy), rows.select(key, *heavy)


#: Version of the packed mask files.
MASK_FORMAT = 2


def box_documents(subjects: DataFrame) -> DataFrame:
    """sample_id, path and text of each sample's box document: its passed subjects with their per-frame boxes, and the dropped ones with their reasons, in order of subject_id."""
    passed, dropped = F.col("status") == "passed", F.col("status") == "dropped"
    item, lost = F.struct("subject_id", "areas", F.col("boxes").alias("bboxes_xyxy")), F.struct("subject_id", "reason")
    rows = subjects.groupBy("sample_id").agg(
        F.sort_array(F.collect_list(F.when(passed, item))).alias("objects"), F.sort_array(F.collect_list(F.when(dropped, lost))).alias("dropped_subjects")
    )
    return rows.where(F.size("objects") > 0).select(
        "sample_id", F.format_string("bbox/%s.json", "sample_id").alias("path"), F.to_json(F.struct("sample_id", "objects", "dropped_subjects")).alias("text")
    )


def mask_files(subjects: DataFrame, width: str = "width") -> DataFrame:
    """sample_id, path, data: each sample's packed masks as one compressed array file, with its subjects' ids, the masks' width and the format's version. Rows need width and frame_count."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("subject_id")
        out, w, frames = io.BytesIO(), int(pdf["w"].iloc[0]), int(pdf["frame_count"].iloc[0])
        masks = [np.frombuffer(x, np.uint8).reshape(frames, -1, (w + 7) // 8) for x in pdf["packed"]]
        np.savez_compressed(out, subject_masks_packed=np.stack(masks), source_subject_ids=pdf["subject_id"].to_numpy(np.int64), mask_width=np.asarray(w), mask_format_version=np.asarray(MASK_FORMAT))
        sample = pdf["sample_id"].iloc[0]
        return pd.DataFrame({"sample_id": [sample], "path": [f"masklets/{sample}.npz"], "data": [out.getvalue()]})

    rows = subjects.where("status = 'passed'").select("sample_id", "subject_id", "frame_count", F.col(width).alias("w"), "packed")
    return rows.groupBy("sample_id").applyInPandas(build, "sample_id string, path string, data binary")
