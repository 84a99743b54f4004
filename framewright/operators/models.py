"""Interfaces of the models and codecs that live outside, with deterministic stand-ins for tests and dry runs.

An instance is made once per Python worker (see `worker_instance`); real models plug in
by giving a factory that can be pickled.
"""

from __future__ import annotations

import io
import os
from collections.abc import Callable
from typing import Any, Protocol

import numpy as np


class Segmenter(Protocol):
    def segment(self, frame: np.ndarray, box: list[int]) -> np.ndarray | None:
        """Mask (height, width) of the instance that the box points at."""


class Tracker(Protocol):
    def track(self, frames: np.ndarray, seed: int, box: list[int], reverse: bool) -> dict[int, np.ndarray]:
        """Masks by frame from the seed frame on, or backwards from it."""


class Detector(Protocol):
    def detect(self, frame: np.ndarray, query: str) -> list[tuple[list[float], float]]:
        """Boxes with scores."""


class Embedder(Protocol):
    def embed(self, crop: np.ndarray | None) -> np.ndarray | None:
        """A vector of a crop; None for none or for one with a side under 2."""


class Codec(Protocol):
    def decode(self, data: bytes) -> np.ndarray: ...

    def encode(self, frames: np.ndarray) -> bytes: ...


class RectangleSegmenter:
    """Sees one rectangular object: the mask is its overlap with the prompt."""

    def __init__(self, thing: list[int]):
        self.thing = thing

    def segment(self, frame: np.ndarray, box: list[int]) -> np.ndarray | None:
        mask = np.zeros(frame.shape[:2], bool)
        x1, y1, x2, y2 = (f(a, b) for f, a, b in zip((max, max, min, min), self.thing, box))
        mask[max(0, y1) : max(0, y2), max(0, x1) : max(0, x2)] = True
        return mask


class HeldTracker:
    """Keeps the seed's box in every frame; there is no reverse pass from the first frame."""

    def track(self, frames: np.ndarray, seed: int, box: list[int], reverse: bool) -> dict[int, np.ndarray]:
        mask = np.zeros(frames.shape[1:3], bool)
        mask[box[1] : box[3], box[0] : box[2]] = True
        return {i: mask for i in (range(seed, -1, -1) if reverse else range(seed, len(frames)))} if not (reverse and seed == 0) else {}


class MeanEmbedder:
    """The mean colour of a crop."""

    def embed(self, crop: np.ndarray | None) -> np.ndarray | None:
        if crop is None or min(crop.shape[:2]) < 2:
            return None
        return crop.reshape(-1, crop.shape[-1]).mean(axis=0)


class ListDetector:
    """Gives what it was given for any query that is not blank."""

    def __init__(self, found: list[tuple[list[float], float]]):
        self.found = found

    def detect(self, frame: np.ndarray, query: str) -> list[tuple[list[float], float]]:
        return self.found if query and query.strip() else []


class RawCodec:
    """Frames as a numpy file in memory."""

    def decode(self, data: bytes) -> np.ndarray:
        return np.load(io.BytesIO(data), allow_pickle=False)[..., :3]

    def encode(self, frames: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.save(out, frames)
        return out.getvalue()


_instances: dict[Any, Any] = {}


def worker_instance(factory: Callable[[], Any]) -> Any:
    """The worker's own instance of a model, made on first use."""
    key = getattr(factory, "__qualname__", factory)
    if key not in _instances:
        _instances[key] = factory()
    return _instances[key]


def newest_snapshot(folder: str) -> str:
    """The latest changed snapshot of a model's folder; the folder itself if it has none. For the driver, before a factory is made."""
    snapshots = os.path.join(folder, "snapshots")
    found = [os.path.join(snapshots, n) for n in os.listdir(snapshots)] if os.path.isdir(snapshots) else []
    return max((p for p in found if os.path.isdir(p)), key=os.path.getmtime, default=folder)
