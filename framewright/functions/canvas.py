"""Annotation canvases: named maps from annotation coordinates to frame pixels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.geometry import Box
from framewright.functions.rounding import half_even

Scales = Callable[[Column, Column], tuple[Column, Column]]

#: Fixed values of the model's resize rule: side multiple, least and most pixels, and the largest aspect ratio.
FACTOR, MIN_PIXELS, MAX_PIXELS, MAX_RATIO = 28, 56 * 56, 14 * 14 * 4 * 1280, 200


def smart_resize(width: Column, height: Column) -> tuple[Column, Column]:
    """(width, height) of the canvas a vision model sees.

    Sides go to the nearest multiple of 28; a product beyond the budget shrinks the
    original sides (rounded down), one below the least grows them (rounded up). Sizes
    below 1 and aspect ratios beyond 200 are errors.
    """
    w, h = width.cast("double"), height.cast("double")
    f = float(FACTOR)
    near_w, near_h = half_even(w / f) * f, half_even(h / f) * f
    over, under = F.sqrt(w * h / float(MAX_PIXELS)), F.sqrt(float(MIN_PIXELS) / (w * h))
    large, small = near_w * near_h > MAX_PIXELS, near_w * near_h < MIN_PIXELS
    bad = ~((w > 0) & (h > 0)) | (F.greatest(w, h) / F.greatest(F.least(w, h), F.lit(1e-9)) > MAX_RATIO)

    def side(own: Column, near: Column) -> Column:
        value = F.when(large, F.floor(own / over / f) * f).when(small, F.ceil(own * under / f) * f).otherwise(near)
        return F.when(bad, F.raise_error(F.lit("sizes must be positive and their ratio at most 200")).cast("int")).otherwise(value.cast("int"))

    return side(w, near_w), side(h, near_h)


def long_edge_canvas(width: Column, height: Column, edge: float = 768.0) -> tuple[Column, Column]:
    """(width, height) of the frame shrunk so that its long edge fits; zeros for sizes below 1."""
    scale = F.lit(edge) / F.greatest(width, height).cast("double")
    ok = (width > 0) & (height > 0)
    return F.when(ok, width * scale).otherwise(0.0), F.when(ok, height * scale).otherwise(0.0)


def by_long_edge(edge: float) -> Scales:
    return lambda w, h: (F.greatest(w, h) / F.lit(edge),) * 2


def by_width(width: float) -> Scales:
    return lambda w, h: (w / F.lit(width),) * 2


def by_both(width: float, height: float) -> Scales:
    return lambda w, h: (w / F.lit(width), h / F.lit(height))


def by_height_of_long_edge(edge: float) -> Scales:
    return lambda w, h: (h / (F.lit(edge) * h / F.greatest(w, h)),) * 2


def by_smart_resize(w: Column, h: Column) -> tuple[Column, Column]:
    cw, ch = smart_resize(half_even(w), half_even(h))
    return w / cw, h / ch


#: Fixed names and sizes of the canvases under comparison, in display order.
CANVASES: dict[str, Scales] = {
    "H_768_long": by_long_edge(768.0),
    "H_1024_long": by_long_edge(1024.0),
    "H_832_iso": by_width(832.0),
    "H_832x480_aniso": by_both(832.0, 480.0),
    "H_y_anchored": by_height_of_long_edge(768.0),
    "H_norm1000": by_both(1000.0, 1000.0),
    "H_qwen_smart": by_smart_resize,
}


def canvas(name: str) -> Scales:
    if name not in CANVASES:
        raise KeyError(f"unknown canvas {name!r}; known: {', '.join(CANVASES)}")
    return CANVASES[name]


def map_box(box: Box, name: str, width: Column, height: Column) -> Box:
    """Annotation to frame pixels, both axes by their own scale; nothing is clamped."""
    sx, sy = canvas(name)(width.cast("double"), height.cast("double"))
    return Box(box.x1 * sx, box.y1 * sy, box.x2 * sx, box.y2 * sy)


def unmap_box(box: Box, name: str, width: Column, height: Column) -> Box:
    """The inverse of map_box."""
    sx, sy = canvas(name)(width.cast("double"), height.cast("double"))
    return Box(box.x1 / sx, box.y1 / sy, box.x2 / sx, box.y2 / sy)
