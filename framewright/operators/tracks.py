"""Mask tracks over frames: areas per frame, gaps, stability, merged half-tracks, diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.geometry import Box, area, clamp_box
from framewright.functions.rounding import round_exact


def series(frames: DataFrame, keys: list[str], count: Column, frame: str = "frame", area: str = "area") -> DataFrame:
    """keys, areas: one array of `count` areas per track, 0 where a frame has no row. A track is bounded by its clip's length."""
    got = frames.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(frame), F.col(area)))).alias("__m"))
    areas = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.coalesce(F.try_element_at("__m", i), F.lit(0)).cast("long"))
    return got.select(*keys, areas.alias("areas"))


def mask_stats(tracks: DataFrame, frame_area: Column, areas: str = "areas") -> DataFrame:
    """tracks with presence and stability numbers; medians are of the frames that have a mask; all zeros and nulls for an empty track."""
    a = F.col(areas)
    out = tracks.withColumns({
        "__seen": F.filter(F.transform(a, lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull()),
        "__pos": F.array_sort(F.filter(a, lambda x: x > 0)),
    })
    n, pos = F.size("__seen"), F.col("__pos")
    middle = (F.get(pos, ((n - 1) / 2).cast("int")) + F.get(pos, (n / 2).cast("int"))) / F.lit(2.0)
    out = out.withColumn("__median", F.when(n > 0, middle).otherwise(0.0))
    first, last, median = F.get("__seen", F.lit(0)), F.get("__seen", n - 1), F.col("__median")
    gaps = F.filter(F.transform(a, lambda x, i: F.when((x == 0) & (i > first) & (i < last), i)), lambda i: i.isNotNull())
    ratio = lambda x: F.when(median > 0, round_exact(x / median, 4)).otherwise(0.0)
    most = F.coalesce(F.array_max(a), F.lit(0))
    return out.withColumns({
        "visible_frame_count": n, "first_mask_frame": first, "last_mask_frame": last, "full_clip_covered": n == F.size(a),
        "max_mask_area": most, "max_mask_area_ratio": round_exact(most / frame_area.cast("double"), 6), "area_median": median.cast("int"), "area_median_exact": median,
        "area_min_ratio": ratio(F.array_min(pos)), "area_max_ratio": ratio(F.array_max(pos)),
        "interior_gap_frames": F.coalesce(gaps, F.array().cast("array<int>")),
    }).drop("__seen", "__pos", "__median")


def is_healthy() -> Column:
    """For a row of mask_stats: every frame has a mask, no gaps, and areas stay within 0.4 and 2.5 times their median."""
    return F.col("full_clip_covered") & (F.size("interior_gap_frames") == 0) & (F.col("area_min_ratio") >= 0.4) & (F.col("area_max_ratio") <= 2.5)


def merged(forward: DataFrame, reverse: DataFrame, keys: list[str], values: list[str], count: int) -> DataFrame:
    """Both half-tracks in one: where both have a frame the forward one wins; frames outside the clip go."""
    f = forward.select(*keys, *(F.col(v).alias(f"__f_{v}") for v in values), F.lit(1).alias("__f"))
    r = reverse.select(*keys, *(F.col(v).alias(f"__r_{v}") for v in values))
    both = f.join(r, keys, "full")
    out = both.select(*keys, *(F.when(F.col("__f") == 1, F.col(f"__f_{v}")).otherwise(F.col(f"__r_{v}")).alias(v) for v in values))
    return out.where((F.col("frame") >= 0) & (F.col("frame") < count))


def coverage_gaps(halves: DataFrame, tracks: DataFrame, keys: list[str], count: int) -> DataFrame:
    """Frames of each track that neither direction wrote."""
    spine = tracks.select(*keys).distinct().withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return spine.join(halves.select(*keys, "frame").distinct(), [*keys, "frame"], "left_anti")


#: Area and fill below which a tightened box is suspicious.
SHRINK, FILL = 0.25, 0.15


def tighten_diagnostics(rows: DataFrame, prompt: Box, tight: Box, pixels: Column, width: Column, height: Column) -> DataFrame:
    """rows with geometric evidence about one tightening each; fail_reason where there is nothing to measure.

    Areas and overlaps are projected before they are rounded, so that no expression is inlined into another many times.
    """
    p = clamp_box(prompt, width, height)
    failed = F.when(~F.coalesce(prompt.known(), F.lit(False)), "degenerate prompt box").when(~tight.known() | pixels.isNull(), "empty mask")
    out = rows.select("*", *(c.cast("double").alias(f"__p{k}") for k, c in enumerate(p)), *(c.cast("double").alias(f"__t{k}") for k, c in enumerate(tight)), pixels.cast("double").alias("__pixels"), width.alias("__w"), height.alias("__h"), failed.alias("fail_reason"))
    p, t = (Box(*(F.col(f"__{side}{k}") for k in range(4))) for side in "pt")
    inter = area(Box(F.greatest(p.x1, t.x1), F.greatest(p.y1, t.y1), F.least(p.x2, t.x2), F.least(p.y2, t.y2)))
    out = out.withColumns({
        "__inter": inter, "__sum": area(p) + area(t), "__prompt": F.greatest(F.lit(1.0), (p.x2 - p.x1) * (p.y2 - p.y1)), "__tight": F.greatest(F.lit(0.0), (t.x2 - t.x1) * (t.y2 - t.y1)),
        "__frame": F.greatest(F.lit(1), F.col("__w") * F.col("__h")).cast("double"),
    })
    prompt_area, tight_area, union = F.col("__prompt"), F.col("__tight"), F.col("__sum") - F.col("__inter")
    own = {
        "mask_share_of_prompt": round_exact(F.col("__pixels") / prompt_area, 6),
        "mask_fill_of_tight": F.when(tight_area > 0, round_exact(F.col("__pixels") / tight_area, 6)).otherwise(0.0),
        "area_ratio": round_exact(tight_area / prompt_area, 6),
        "box_shift_iou": F.when(union > 0, round_exact(F.col("__inter") / union, 4)),
        "touches_frame_edge": (t.x1 <= 0) | (t.y1 <= 0) | (t.x2 >= F.col("__w")) | (t.y2 >= F.col("__h")),
        "tight_area_frac_of_frame": round_exact(tight_area / F.col("__frame"), 6),
    }
    ok = F.col("fail_reason").isNull()
    out = out.withColumns({"tightened": ok} | {k: F.when(ok, c) for k, c in own.items()})
    out = out.withColumns({"suspect_shrink": F.col("area_ratio") < SHRINK, "suspect_thin": F.col("mask_fill_of_tight") < FILL})
    return out.drop(*(c for c in out.columns if c.startswith("__") and c not in rows.columns))
