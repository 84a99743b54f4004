"""Report rows of subjects: boxes of both sides tightened, or pooled with a detector's and paired by identity.

A sample is one row with its clip and its subjects, so a clip is decoded once. Boxes are
mapped from the annotation canvas against the size of their own frame: the clip's for the
seed, the reference's for the reference. Everything else is relational: `report` counts
the rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators import raster
from framewright.operators.models import Codec, Detector, Embedder, Segmenter, worker_instance
from framewright.operators.pool import PICKS, SAME_IOU

#: Long edge of the annotation canvas, least area of a detection in shares of the annotated box, failures after which a run without any result is given up.
CANVAS, LEAST_AREA, FAILURES = 768.0, 0.30, 3

ROW = (
    "sample_id string, subject_id int, phrase string, seed_frame_index int, status string, error string, prompt_ref array<double>, prompt_seed array<double>, box_ref array<int>, box_seed array<int>,"
    " pick_ref string, pick_seed string, reason_ref string, reason_seed string, both_tightened boolean, identity double, margin double, pairs_scored int, ref_candidates int, seed_candidates int,"
    " used_detector boolean, pairs array<struct<ref_index: int, seed_index: int, similarity: double>>, stop_ref string, stop_seed string, seconds double"
)
_COLUMNS = [part.strip().split(" ")[0] for part in ROW.replace("array<struct<ref_index: int, seed_index: int, similarity: double>>", "array").split(",")]


@dataclass
class Candidate:
    origin: str
    box: list[int]
    mask: np.ndarray
    also: list[str] = field(default_factory=list)


def on_frame(box, width: int, height: int) -> list[float] | None:
    """An annotation box in a frame's pixels, corners in order and clipped to the frame."""
    if box is None or len(box) != 4:
        return None
    scale = max(width, height) / CANVAS
    x, y = sorted((box[0] * scale, box[2] * scale)), sorted((box[1] * scale, box[3] * scale))
    return [min(max(x[0], 0.0), width), min(max(y[0], 0.0), height), min(max(x[1], 0.0), width), min(max(y[1], 0.0), height)]


def overlap(a: list[int], b: list[int]) -> float:
    size = lambda c: max(0, c[2] - c[0]) * max(0, c[3] - c[1])
    inner = size([max(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), min(a[3], b[3])])
    union = size(a) + size(b) - inner
    return round(inner / union, 4) if union > 0 else 0.0


def candidates(segmenter: Segmenter, detector: Detector | None, frame: np.ndarray, prompt: list[float] | None, query: str, picks: int = PICKS) -> list[Candidate]:
    """The annotated box, then the detector's best that are no mere parts of it, each as the box of its mask; boxes that repeat an earlier one join it."""
    height, width = frame.shape[:2]
    own = raster.clamp(prompt, width, height) if prompt is not None else None
    tried = [("annotation", own)] if own else []
    if detector is not None and query.strip():
        for box, _ in detector.detect(frame, query)[:picks]:
            box = raster.clamp(box, width, height)
            if own is None or (box[2] - box[0]) * (box[3] - box[1]) >= LEAST_AREA * max(1, (own[2] - own[0]) * (own[3] - own[1])):
                tried.append(("detector", box))
    kept: list[Candidate] = []
    for origin, box in tried:
        found = raster.tighten(segmenter, frame, box, rounds=0)
        if found["tight"] is None:
            continue
        same = next((k for k in kept if overlap(found["tight"], k.box) >= SAME_IOU), None)
        if same is not None:
            same.also.append(origin)
        else:
            kept.append(Candidate(origin, found["tight"], found["mask"]))
    return kept


def similarity(a: np.ndarray | None, b: np.ndarray | None) -> float | None:
    """1 minus the cosine distance of two embeddings, six decimals; None where either is missing or zero."""
    if a is None or b is None:
        return None
    norm = float(np.linalg.norm(a) * np.linalg.norm(b))
    return round(1.0 - (1.0 - float(np.dot(a, b)) / norm), 6) if norm > 0 else None


def best_pair(embedder: Embedder, reference: np.ndarray, refs: list[Candidate], frame: np.ndarray, seeds: list[Candidate]) -> dict[str, Any]:
    """Every candidate is embedded once, every pair is scored; the best one (the first of equals) with its margin over the next."""
    left, right = ([embedder.embed(raster.cutout(image, c.mask, c.box)) for c in side] for image, side in ((reference, refs), (frame, seeds)))
    scored = [(i, j, s) for i, a in enumerate(left) for j, b in enumerate(right) if (s := similarity(a, b)) is not None]
    scored.sort(key=lambda p: -p[2])
    out = {"pairs": scored, "pairs_scored": len(scored), "ref_candidates": len(refs), "seed_candidates": len(seeds), "used_detector": False, "identity": None, "margin": None, "chosen": (None, None)}
    if scored:
        i, j, s = scored[0]
        out |= {"identity": s, "margin": round(s - scored[1][2], 6) if len(scored) > 1 else None, "chosen": (refs[i], seeds[j]), "used_detector": "detector" in (refs[i].origin, seeds[j].origin)}
    return out


def paired(segmenter: Segmenter, detector: Detector, embedder: Embedder, reference: np.ndarray, ref_box, frame: np.ndarray, seed_box, query: str) -> dict[str, Any]:
    """A subject by its pools of candidates."""
    refs, seeds = (candidates(segmenter, detector, image, box, query) for image, box in ((reference, ref_box), (frame, seed_box)))
    ranked = best_pair(embedder, reference, refs, frame, seeds)
    picks = ranked.pop("chosen")
    out = ranked | {"both_tightened": all(p is not None for p in picks)}
    for side, pick, pool in zip(("ref", "seed"), picks, (refs, seeds)):
        reason = f"{pick.origin}, first of {len(pool)} by identity" if pick else "no candidate has a mask"
        out |= {f"box_{side}": pick.box if pick else None, f"pick_{side}": "dis" if pick else "no_box", f"reason_{side}": reason, f"stop_{side}": None}
    return out


def tightened(segmenter: Segmenter, embedder: Embedder, reference: np.ndarray, ref_box, frame: np.ndarray, seed_box) -> dict[str, Any]:
    """A subject by its annotated boxes alone."""
    *sides, both = raster.tighten_both(segmenter, reference, ref_box, frame, seed_box)
    crops = [raster.cutout(image, s["mask"], s["tight"]) for image, s in zip((reference, frame), sides)]
    identity = similarity(*(embedder.embed(c) if c is not None else None for c in crops))
    out = {"both_tightened": both, "identity": identity, "margin": None, "pairs": None, "pairs_scored": None, "ref_candidates": None, "seed_candidates": None, "used_detector": False}
    for side, s in zip(("ref", "seed"), sides):
        out |= {f"box_{side}": s["tight"], f"pick_{side}": "dis" if s["tight"] else "no_box", f"reason_{side}": "the annotated box, tightened", f"stop_{side}": s["stop"]}
    return out


def report_rows(
    samples: DataFrame, codec: Callable[[], Codec], segmenter: Callable[[], Segmenter], embedder: Callable[[], Embedder], detector: Callable[[], Detector] | None = None
) -> DataFrame:
    """One row (ROW) per subject of rows sample_id, clip (encoded), subjects: array of subject_id, phrase, query, seed_frame_index, seed_box, reference (encoded), ref_box.

    status is built, or failed with its error. A failure ends its sample: subjects before it
    stay, one failed row names the sample, those after it have no row. The seed frame is
    capped at the clip's last one.
    """

    def one(sample, subject, frames: np.ndarray, tools) -> dict[str, Any]:
        started = time.perf_counter()
        c, s, e, found = tools
        frame, reference = frames[min(int(subject["seed_frame_index"]), len(frames) - 1)], c.decode(subject["reference"])
        ref_box, seed_box = (on_frame(subject[k], image.shape[1], image.shape[0]) for k, image in (("ref_box", reference), ("seed_box", frame)))
        own = paired(s, found, e, reference, ref_box, frame, seed_box, subject["query"] or "") if found else tightened(s, e, reference, ref_box, frame, seed_box)
        return own | {
            "sample_id": sample.sample_id, "subject_id": subject["subject_id"], "phrase": subject["phrase"], "seed_frame_index": subject["seed_frame_index"], "status": "built",
            "prompt_ref": ref_box, "prompt_seed": seed_box, "seconds": time.perf_counter() - started,
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = [worker_instance(f) if f is not None else None for f in (codec, segmenter, embedder, detector)]
        for pdf in batches:
            rows: list[dict[str, Any]] = []
            for sample in pdf.itertuples(index=False):
                try:
                    frames = tools[0].decode(sample.clip)
                    if not len(frames):
                        raise ValueError("the clip has no frames")
                    for subject in sample.subjects:
                        rows.append(one(sample, subject, frames, tools))
                except Exception as error:  # one bad clip must not end the run
                    rows.append({"sample_id": sample.sample_id, "status": "failed", "error": f"{type(error).__name__}: {error}", "both_tightened": False, "used_detector": False})
            yield pd.DataFrame([[r.get(k) for k in _COLUMNS] for r in rows], columns=_COLUMNS).astype(object)

    return samples.select("sample_id", "clip", "subjects").mapInPandas(run, ROW)


def counts(rows: DataFrame) -> DataFrame:
    """One row of a report's counts: subjects, both_tightened, failures, detector_won, and aborted: whether nothing was produced and at least FAILURES samples failed, which is a fault of the surroundings and not of the clips."""
    built, failed = F.col("status") == "built", F.col("status") == "failed"
    some = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return rows.agg(
        F.count_if(built).alias("subjects"), some(built & F.col("both_tightened")).alias("both_tightened"), F.count_if(failed).alias("failures"),
        some(built & F.col("used_detector")).alias("detector_won"), ((F.count_if(built) == 0) & (F.count_if(failed) >= FAILURES)).alias("aborted"),
    )


def timing(rows: DataFrame, wall: float) -> DataFrame:
    """wall_sec (2 decimals) and sec_per_subject (3) of a run that took `wall` seconds, and worker_sec, the seconds spent inside workers."""
    built = F.count_if(F.col("status") == "built")
    return rows.agg(F.lit(round(wall, 2)).alias("wall_sec"), F.round(F.lit(wall) / F.greatest(F.lit(1), built), 3).alias("sec_per_subject"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("worker_sec"))
