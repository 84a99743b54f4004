"""Per-sample work around the models: clips to frames, tracks of subjects, outcomes as rows instead of exceptions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from framewright.operators import raster
from framewright.operators.models import Codec, Segmenter, Tracker, worker_instance


def resized(frames: np.ndarray, width: int, height: int) -> np.ndarray:
    """Frames at another size by nearest pixels (a codec may do better); the same object if the size is right."""
    if frames.shape[1:3] == (height, width):
        return frames
    rows = np.minimum((np.arange(height) + 0.5) * frames.shape[1] / height, frames.shape[1] - 1).astype(int)
    columns = np.minimum((np.arange(width) + 0.5) * frames.shape[2] / width, frames.shape[2] - 1).astype(int)
    return frames[:, rows][:, :, columns]


def extract(clips: DataFrame, codec: Callable[[], Codec]) -> DataFrame:
    """sample_id, status (passed or failed), error, frame_count, width, height, clip of rows sample_id, data, indices, width, height: the frames of a window, at the stored size."""

    def one(r, tool: Codec):
        try:
            frames = tool.decode(r.data)
            picked = frames[[max(0, min(int(i), len(frames) - 1)) for i in r.indices]]
            out = resized(picked, int(r.width), int(r.height))
            return (r.sample_id, "passed", None, len(out), int(r.width), int(r.height), tool.encode(out))
        except Exception as e:  # a bad clip is a failed row, not a failed job
            return (r.sample_id, "failed", f"{type(e).__name__}: {e}", None, None, None, None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = worker_instance(codec)
        for pdf in batches:
            yield pd.DataFrame([one(r, tool) for r in pdf.itertuples(index=False)], columns=["sample_id", "status", "error", "frame_count", "width", "height", "clip"])

    return clips.mapInPandas(run, "sample_id string, status string, error string, frame_count int, width int, height int, clip binary")


def segment(samples: DataFrame, codec: Callable[[], Codec], segmenter: Callable[[], Segmenter], tracker: Callable[[], Tracker]) -> DataFrame:
    """One row per subject of rows sample_id, clip, subject_id, seed_frame, seed_box, reference (encoded), ref_box: status passed, dropped (with its reason) or failed; areas, boxes and the packed track, and of the despeckled reference its box, coverage, components and cutouts (on white, and with an alpha channel).

    A sample of which no subject passes is rejected: see `rejected_samples`.
    """
    columns = ["sample_id", "subject_id", "status", "reason", "areas", "boxes", "packed", "ref_box", "ref_coverage", "ref_components", "ref_largest_share", "cutout", "cutout_alpha"]

    def one(r, c: Codec, s: Segmenter, t: Tracker):
        def ended(status, reason):
            return (r.sample_id, r.subject_id, status, reason, *[None] * 9)

        try:
            frames = c.decode(r.clip)
            count, height, width = frames.shape[:3]
            if not 0 <= r.seed_frame < count:
                return ended("dropped", "seed_frame_out_of_range")
            box = raster.clamp(list(r.seed_box), width, height)
            if min(r.seed_box[2] - r.seed_box[0], r.seed_box[3] - r.seed_box[1]) < 2:
                return ended("dropped", "degenerate_seed_box")
            ahead = t.track(frames, int(r.seed_frame), box, False)
            back = t.track(frames, int(r.seed_frame), box, True) if r.seed_frame > 0 else {}  # nothing lies before the first frame
            masks = np.zeros(frames.shape[:3], bool)
            for half in (back, ahead):
                for i, mask in half.items():
                    if 0 <= i < count:
                        clean = raster.without_speckle(mask)
                        masks[i] = clean if clean.any() else mask
            if missing := set(range(count)) - set(back) - set(ahead):
                return ended("failed", f"frames without a mask: {sorted(missing)[:5]}")
            if not masks.any():
                return ended("dropped", "empty_masklet")
            if min(r.ref_box[2] - r.ref_box[0], r.ref_box[3] - r.ref_box[1]) < 2:
                return ended("dropped", "degenerate_ref_box")
            reference = c.decode(r.reference)
            found = s.segment(reference, raster.clamp(list(r.ref_box), reference.shape[1], reference.shape[0]))
            found = raster.without_speckle(found) if found is not None else None
            if found is None or not found.any():
                return ended("dropped", "empty_ref_mask")
            boxes, (parts, share) = [raster.mask_box(m) for m in masks], raster.component_stats(found)
            x1, y1, x2, y2 = window = raster.mask_box(found)
            shown = (window, round(float(found[y1:y2, x1:x2].mean()), 6), parts, share, c.encode(raster.cutout(reference, found)), c.encode(raster.cutout_alpha(reference, found)))
            return (r.sample_id, r.subject_id, "passed", None, [int(m.sum()) for m in masks], boxes, raster.pack(masks).tobytes(), *shown)
        except Exception as e:
            return ended("failed", f"{type(e).__name__}: {e}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = worker_instance(codec), worker_instance(segmenter), worker_instance(tracker)
        for pdf in batches:
            yield pd.DataFrame([one(r, *tools) for r in pdf.itertuples(index=False)], columns=columns)

    return samples.mapInPandas(run, "sample_id string, subject_id int, status string, reason string, areas array<long>, boxes array<array<int>>, packed binary, ref_box array<int>, ref_coverage double, ref_components int, ref_largest_share double, cutout binary, cutout_alpha binary")


def sample_status(subjects: DataFrame) -> DataFrame:
    """sample_id, status: failed if any subject failed, passed if any passed, else rejected (its subjects were all dropped)."""
    from pyspark.sql import functions as F

    return subjects.groupBy("sample_id").agg(
        F.when(F.max(F.col("status") == "failed"), "failed").when(F.max(F.col("status") == "passed"), "passed").otherwise("rejected").alias("status")
    )
