"""Boxes as four columns (left, top, right, bottom; right and bottom exclusive): clamps, overlaps, storage geometry."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.rounding import half_even_int, half_up_steps, round_exact


class Box(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @classmethod
    def of(cls, prefix: str = "") -> Box:
        return cls(*(F.col(prefix + c) for c in ("x1", "y1", "x2", "y2")))

    @classmethod
    def from_array(cls, array: Column) -> Box:
        return cls(*(F.get(array, k) for k in range(4)))

    def each(self, f) -> Box:
        return Box(*map(f, self))

    def array(self) -> Column:
        return F.array(*self)

    def columns(self, prefix: str = "") -> list[Column]:
        return [c.alias(prefix + n) for n, c in zip(("x1", "y1", "x2", "y2"), self)]

    def known(self) -> Column:
        return self.x1.isNotNull() & self.y1.isNotNull() & self.x2.isNotNull() & self.y2.isNotNull()


def is_box(array: Column) -> Column:
    """Exactly four numbers."""
    return F.coalesce((F.size(array) == 4) & F.forall(array, lambda x: x.isNotNull()), F.lit(False))


def clamp_box(box: Box, width: Column, height: Column) -> Box:
    """Whole pixels inside the frame, never empty; corners stay in their order; null unless all four are known."""
    known = box.known()
    x1 = F.greatest(F.lit(0), F.least(half_even_int(box.x1), width - 1))
    y1 = F.greatest(F.lit(0), F.least(half_even_int(box.y1), height - 1))
    x2 = F.greatest(x1 + 1, F.least(half_even_int(box.x2), width))
    y2 = F.greatest(y1 + 1, F.least(half_even_int(box.y2), height))
    return Box(x1, y1, x2, y2).each(lambda c: F.when(known, c))


def clamp_to_frame(box: Box, width: Column, height: Column) -> Box:
    """Corners put in order and clipped to the frame; may be empty."""
    def clip(c, most):
        return F.least(F.greatest(c, F.lit(0.0)), most.cast("double"))

    return Box(
        clip(F.least(box.x1, box.x2), width), clip(F.least(box.y1, box.y2), height),
        clip(F.greatest(box.x1, box.x2), width), clip(F.greatest(box.y1, box.y2), height),
    )


def is_degenerate(box: Box, least_side: float = 2.0) -> Column:
    return ((box.x2 - box.x1) < least_side) | ((box.y2 - box.y1) < least_side)


def area(box: Box) -> Column:
    """Area, 0 for boxes turned inside out."""
    return F.greatest(F.lit(0.0), box.x2 - box.x1) * F.greatest(F.lit(0.0), box.y2 - box.y1)


def box_fraction(box: Box, width: Column, height: Column) -> Column:
    """The box's own share of the frame's area, five decimals; above 1 if it reaches beyond."""
    return round_exact(area(box) / (width * height).cast("double"), 5)


def iou(a: Box, b: Box, digits: int = 4) -> Column:
    """Intersection over union; null if the union is empty or a corner unknown."""
    inter = area(Box(F.greatest(a.x1, b.x1), F.greatest(a.y1, b.y1), F.least(a.x2, b.x2), F.least(a.y2, b.y2)))
    union = area(a) + area(b) - inter
    return F.when(a.known() & b.known() & (union > 0), round_exact(inter / union, digits))


def scale_box(box: Box, source_w: Column, source_h: Column, stored_w: Column, stored_h: Column) -> Box:
    """A frame-space box carried from the source's size to the stored size."""
    sx, sy = stored_w / source_w.cast("double"), stored_h / source_h.cast("double")
    return Box(box.x1 * sx, box.y1 * sy, box.x2 * sx, box.y2 * sy)


def dilate_box(box: Box, width: Column, height: Column, step: float = 0.1) -> Box:
    """The box grown by a share of its own size on every side, then clamped to whole pixels."""
    dx, dy = (box.x2 - box.x1) * step, (box.y2 - box.y1) * step
    return clamp_box(Box(box.x1 - dx, box.y1 - dy, box.x2 + dx, box.y2 + dy), width, height)


def pinned_edges(tight: Box, prompt: Box, width: Column, height: Column, slack: int = 2) -> Column:
    """Edges of the prompt that the tight box touches within the slack, unless they are the frame's own."""
    edges = (
        ("left", (tight.x1 - prompt.x1 <= slack) & (prompt.x1 > 0)),
        ("top", (tight.y1 - prompt.y1 <= slack) & (prompt.y1 > 0)),
        ("right", (prompt.x2 - tight.x2 <= slack) & (prompt.x2 < width)),
        ("bottom", (prompt.y2 - tight.y2 <= slack) & (prompt.y2 < height)),
    )
    return F.filter(F.array(*(F.when(test, F.lit(name)) for name, test in edges)), lambda x: x.isNotNull())


def is_plausible(box: Box, reference: Box, share: float = 0.30) -> Column:
    """Whether a box is large enough to be the whole of what the reference box holds; true without a reference."""
    least = F.greatest(F.lit(1.0), (reference.x2 - reference.x1) * (reference.y2 - reference.y1)) * share
    return ~reference.known() | (area(box) >= least)


def resolve_box(box: Box, space: Column, width: Column, height: Column, canvas: float = 768.0) -> Box:
    """Frame pixels of a box: annotation space is mapped from its canvas and clamped, frame space only clamped; any other space is an error."""
    scale = F.greatest(width, height) / F.lit(canvas)
    mapped, own = clamp_to_frame(box.each(lambda c: c * scale), width, height), clamp_to_frame(box, width, height)
    bad = F.raise_error(F.concat(F.lit("unknown box space: "), F.coalesce(space, F.lit("null")))).cast("double")
    return Box(*(F.when(space == "annotation", m).when(space == "frame", o).otherwise(bad) for m, o in zip(mapped, own)))


def snap(value: Column, multiple: int = 2) -> Column:
    """The nearest positive multiple, halves upward."""
    if multiple <= 1:
        return F.greatest(F.lit(1), half_up_steps(value).cast("int"))
    return F.greatest(F.lit(1), half_up_steps(value / float(multiple)).cast("int")) * multiple


def stored_dims(width: Column, height: Column, target: int = 480, multiple: int = 2) -> tuple[Column, Column]:
    """Stored (width, height): scaled down to the target height, never up; sizes that stay are not snapped; sizes below 1 are an error."""
    bad = F.raise_error(F.lit("source dimensions must be positive")).cast("int")
    stay = F.lit(target <= 0) | (height <= target)
    scale = F.lit(float(target)) / height
    ok = (width > 0) & (height > 0)
    return (
        F.when(~ok, bad).when(stay, width).otherwise(snap(width * scale, multiple)),
        F.when(~ok, bad).when(stay, height).otherwise(snap(height * scale, multiple)),
    )


class Crop(NamedTuple):
    scale: Column
    width: Column
    height: Column
    discard_width: Column
    discard_height: Column


def training_crop(width: Column, height: Column, target_w: int = 832, target_h: int = 480) -> Crop:
    """What a centre crop to the target size scales to and throws away of each axis."""
    scale = F.greatest(F.lit(float(target_w)) / width, F.lit(float(target_h)) / height)
    w, h = half_even_int(width * scale), half_even_int(height * scale)
    return Crop(
        round_exact(scale, 6), w, h,
        round_exact(F.greatest(F.lit(0.0), (w - target_w) / w), 6), round_exact(F.greatest(F.lit(0.0), (h - target_h) / h), 6),
    )


#: Share of an axis above which a crop is flagged (never dropped).
DISCARD_FLAG = 0.20


def storage_plan(width: Column, height: Column, target_h: int = 480, target_w: int = 832) -> dict[str, Column]:
    """A sample's whole storage geometry, as named columns."""
    w, h = stored_dims(width, height, target_h)
    crop = training_crop(w, h, target_w, target_h)
    return {
        "source_width": width, "source_height": height, "width": w, "height": h,
        "target_width": F.lit(target_w), "target_height": F.lit(target_h),
        "scaled": (w != width) | (h != height), "scale": round_exact(h / height.cast("double"), 6),
        "train_crop_scale": crop.scale, "train_discard_width": crop.discard_width, "train_discard_height": crop.discard_height,
        "crop_discard_excessive": (crop.discard_width > DISCARD_FLAG) | (crop.discard_height > DISCARD_FLAG),
    }
