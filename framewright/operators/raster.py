"""Masks as numpy arrays inside Arrow batches: boxes, components, packing, cutouts, and the tightening loop around a segmenter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from framewright.operators.models import Segmenter

#: A component is speckle below this share of the largest one or below so many pixels.
LEAST_SHARE, LEAST_PIXELS = 0.05, 16
#: A box's edges in their order, and the direction in which the box lies from each.
EDGES = (("left", -1), ("top", -1), ("right", 1), ("bottom", 1))


def mask_box(mask: np.ndarray) -> list[int] | None:
    """Left, top, right, bottom (exclusive) of the set pixels; None if there are none."""
    rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    return [int(columns[0]), int(rows[0]), int(columns[-1]) + 1, int(rows[-1]) + 1] if len(rows) else None


def label(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(component number of each pixel from 1 on, 0 outside; pixels of each component). Neighbours share an edge.

    Horizontal runs are the nodes; runs of adjacent rows that overlap are linked, and the
    least number spreads along links until nothing changes.
    """
    m = np.asarray(mask, bool)
    h, w = m.shape
    padded = np.zeros((h, w + 2), np.int8)
    padded[:, 1:-1] = m
    step = np.diff(padded, axis=1)
    row, start = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    n = len(row)
    if not n:
        return np.zeros((h, w), np.int64), np.empty(0, np.int64)
    number = np.zeros((h, w), np.int64)
    flat = np.repeat(np.arange(1, n + 1), end - start)
    number[m] = flat
    both = (number[1:] > 0) & (number[:-1] > 0)
    a, b = number[1:][both] - 1, number[:-1][both] - 1
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    _, own = np.unique(root, return_inverse=True)
    labels = np.zeros((h, w), np.int64)
    labels[m] = own[flat - 1] + 1
    return labels, np.bincount(own, end - start).astype(np.int64)


def without_speckle(mask: np.ndarray, share: float = LEAST_SHARE, pixels: int = LEAST_PIXELS) -> np.ndarray:
    """The mask without components under a share of the largest or under a number of pixels; untouched if it has one component at most."""
    labels, sizes = label(mask)
    if len(sizes) <= 1:
        return np.asarray(mask, bool)
    keep = np.concatenate(([False], sizes >= max(sizes.max() * share, pixels)))
    return keep[labels]


def component_stats(mask: np.ndarray) -> tuple[int, float]:
    """Number of components and the largest one's share of all set pixels."""
    _, sizes = label(mask)
    return len(sizes), round(float(sizes.max()) / float(sizes.sum()), 6) if len(sizes) else 0.0


def pack(masks: np.ndarray) -> np.ndarray:
    """Eight pixels of a row in a byte."""
    return np.packbits(np.asarray(masks, bool), axis=-1)


def unpack(packed: np.ndarray, width: int) -> np.ndarray:
    return np.unpackbits(np.asarray(packed, np.uint8), axis=-1)[..., :width].astype(bool)


def outline(mask: np.ndarray) -> np.ndarray:
    """Set pixels with an unset neighbour or at the frame's edge."""
    m = np.pad(np.asarray(mask, bool), 1)
    inner = m[1:-1, 1:-1] & m[:-2, 1:-1] & m[2:, 1:-1] & m[1:-1, :-2] & m[1:-1, 2:]
    return m[1:-1, 1:-1] & ~inner


def thick_outline(mask: np.ndarray, steps: int = 2) -> np.ndarray:
    """Set pixels within `steps` steps of an unset one or of the frame's edge; an empty mask stays."""
    inner = np.asarray(mask, bool)
    for _ in range(steps):
        inner = inner & ~outline(inner)
    return np.asarray(mask, bool) & ~inner


def crop_box(frame: np.ndarray, box: list[float] | None) -> np.ndarray | None:
    """What the box shows of the frame, clamped to whole pixels and never empty; None unless it is four numbers."""
    if box is None or len(box) != 4 or any(v is None for v in box):
        return None
    x1, y1, x2, y2 = clamp(box, frame.shape[1], frame.shape[0])
    return np.asarray(frame[y1:y2, x1:x2], np.uint8)


def cutout(frame: np.ndarray, mask: np.ndarray | None, box: list[int] | None = None) -> np.ndarray | None:
    """The masked pixels on white, cropped to the box or else the mask's own; None if there is nothing to show."""
    box = box or (mask_box(mask) if mask is not None else None)
    if mask is None or box is None or not mask.any():
        return None
    x1, y1, x2, y2 = box
    return np.where(mask[y1:y2, x1:x2, None], frame[y1:y2, x1:x2], 255).astype(np.uint8)


def cutout_alpha(frame: np.ndarray, mask: np.ndarray | None) -> np.ndarray | None:
    """The mask's box with the mask as a fourth, alpha channel; None if the mask is empty."""
    box = mask_box(mask) if mask is not None else None
    if box is None:
        return None
    x1, y1, x2, y2 = box
    return np.dstack((frame[y1:y2, x1:x2], np.where(mask[y1:y2, x1:x2], 255, 0))).astype(np.uint8)


def clamp(box: list[float], width: int, height: int) -> list[int]:
    x1, y1 = max(0, min(round(box[0]), width - 1)), max(0, min(round(box[1]), height - 1))
    return [x1, y1, max(x1 + 1, min(round(box[2]), width)), max(y1 + 1, min(round(box[3]), height))]


def pinned(tight: list[int], prompt: list[int], width: int, height: int, slack: int = 2) -> list[str]:
    """EDGES that the tight box touches within the slack and that can still move."""
    limits = (0, 0, width, height)
    return [name for k, (name, sign) in enumerate(EDGES) if sign * (prompt[k] - tight[k]) <= slack and prompt[k] != limits[k]]


def tighten(segmenter: Segmenter, frame: np.ndarray, box: list[float] | None, rounds: int = 3, step: float = 0.15) -> dict:
    """Segment a box, growing it while the mask touches one of its free edges.

    Returns mask, tight (its box), prompt (the last one tried), rounds grown, history (the
    prompt, its tight box and its free edges that were touched, of every round), growth (area
    of the last prompt in shares of the first) and stop, one of degenerate, empty, emptied,
    settled, limit, edge. The last mask found is kept.
    """
    height, width = frame.shape[:2]
    none = {"mask": None, "tight": None, "prompt": None, "rounds": 0, "history": [], "growth": None, "stop": "degenerate"}
    if box is None or len(box) != 4 or any(v is None for v in box):
        return none
    prompt = clamp(box, width, height)
    if min(prompt[2] - prompt[0], prompt[3] - prompt[1]) < 2:
        return none
    out, area = none | {"prompt": prompt, "growth": 1.0}, lambda b: (b[2] - b[0]) * (b[3] - b[1])
    first, history = area(prompt), []
    out["history"] = history
    for turn in range(rounds + 1):
        mask = segmenter.segment(frame, prompt)
        if mask is None or not mask.any():
            return out | {"prompt": prompt, "stop": "empty" if out["mask"] is None else "emptied"}
        out |= {"mask": mask, "tight": mask_box(mask), "prompt": prompt, "rounds": turn, "growth": round(area(prompt) / first, 6)}
        touched = pinned(out["tight"], prompt, width, height)
        history.append((prompt, out["tight"], touched))
        if not touched:
            return out | {"stop": "settled"}
        dx, dy = (prompt[2] - prompt[0]) * step, (prompt[3] - prompt[1]) * step
        grown = clamp([prompt[0] - dx, prompt[1] - dy, prompt[2] + dx, prompt[3] + dy], width, height)
        if turn < rounds and grown == prompt:
            return out | {"stop": "edge"}
        prompt = grown
    return out | {"stop": "limit"}


def tighten_both(segmenter: Segmenter, reference: np.ndarray, ref_box: list[float] | None, frame: np.ndarray, seed_box: list[float] | None, rounds: int = 3) -> tuple[dict, dict, bool]:
    """Both sides of a subject, and whether both have a box: one side alone trains nothing."""
    sides = tighten(segmenter, reference, ref_box, rounds), tighten(segmenter, frame, seed_box, rounds)
    return *sides, all(s["tight"] is not None for s in sides)


def measured(masks: DataFrame) -> DataFrame:
    """key, box, components, largest_share, pixels after despeckling, packed bytes, of rows key, h, w, packed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                mask = unpack(np.frombuffer(r.packed, np.uint8).reshape(r.h, -1), r.w)
                count, share = component_stats(mask)
                clean = without_speckle(mask)
                rows.append((r.key, mask_box(mask), count, share, int(clean.sum()), pack(clean).tobytes()))
            yield pd.DataFrame(rows, columns=["key", "box", "components", "largest_share", "pixels", "packed"])

    return masks.select("key", "h", "w", "packed").mapInPandas(run, "key long, box array<int>, components int, largest_share double, pixels long, packed binary")
