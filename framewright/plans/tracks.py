"""Queries over mask tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions.geometry import Box
from framewright.operators import tracks
from framewright.plans import derived as d
from framewright.plans.boxes import _clamp, _round
from framewright.plans.registry import joined, query

_STATS = (
    "seen AS (SELECT user_id, count(*) FILTER (area > 0) AS visible, min(frame) FILTER (area > 0) AS first, max(frame) FILTER (area > 0) AS last, max(area) AS most,"
    " median(area) FILTER (area > 0) AS med, min(area) FILTER (area > 0) AS lo, max(area) FILTER (area > 0) AS hi FROM frames GROUP BY user_id),"
    " gaps AS (SELECT f.user_id, list(f.frame ORDER BY f.frame) AS gaps FROM frames f JOIN seen s USING (user_id) WHERE f.area = 0 AND f.frame > s.first AND f.frame < s.last GROUP BY f.user_id),"
    f" stats AS (SELECT s.*, coalesce(g.gaps, []) AS gaps, {_round('s.lo / s.med', 4)} AS lo_ratio, {_round('s.hi / s.med', 4)} AS hi_ratio FROM seen s LEFT JOIN gaps g USING (user_id))"
)


def _stats(spark, sf_dir):
    areas = tracks.series(d.days(spark, sf_dir), ["user_id"], F.lit(d.FRAMES))
    return tracks.mask_stats(areas, F.lit(100))


@query(
    f"SELECT user_id, CAST(visible AS INTEGER) AS visible_frame_count, first AS first_mask_frame, last AS last_mask_frame, visible = 30 AS full_clip_covered, most AS max_mask_area, {_round('most / 100.0::DOUBLE', 6)} AS max_mask_area_ratio,"
    " CAST(floor(med) AS INTEGER) AS area_median, lo_ratio AS area_min_ratio, hi_ratio AS area_max_ratio, array_to_string(gaps, ',') AS interior_gap_frames FROM stats",
    d.DAYS, _STATS,
)
def mask_stats(spark, sf_dir):
    return _stats(spark, sf_dir).drop("areas", "area_median_exact").withColumn("interior_gap_frames", joined(F.col("interior_gap_frames")))


@query("SELECT user_id, CAST(unnest(gaps) AS INTEGER) AS frame FROM stats", d.DAYS, _STATS)
def interior_gaps(spark, sf_dir):
    return _stats(spark, sf_dir).select("user_id", F.explode("interior_gap_frames").alias("frame"))


@query("SELECT s.user_id, string_agg(CAST(f.area AS VARCHAR), ',' ORDER BY f.frame) AS areas, any_value(s.med) AS area_median FROM stats s JOIN frames f USING (user_id) GROUP BY s.user_id", d.DAYS, _STATS)
def frame_series(spark, sf_dir):
    return _stats(spark, sf_dir).select("user_id", joined(F.col("areas")).alias("areas"), F.col("area_median_exact").alias("area_median"))


@query("SELECT visible = 30 AND len(gaps) = 0 AND lo_ratio >= 0.4 AND hi_ratio <= 2.5 AS healthy, count(*) AS n FROM stats GROUP BY 1", d.DAYS, _STATS)
def mask_health(spark, sf_dir):
    return _stats(spark, sf_dir).groupBy(tracks.is_healthy().alias("healthy")).agg(F.count("*").alias("n"))


_HALVES = (
    "forward AS (SELECT * FROM days WHERE frame >= user_id % 20 AND (frame + user_id) % 9 <> 0), reverse AS (SELECT user_id, frame, area + 1000 AS area FROM days WHERE frame <= user_id % 20 + 2),"
    " merged AS (SELECT user_id, frame, CASE WHEN f.area IS NOT NULL THEN f.area ELSE r.area END AS area FROM forward f FULL JOIN reverse r USING (user_id, frame) WHERE frame >= 0 AND frame < 28)"
)


def _halves(spark, sf_dir):
    rows = d.days(spark, sf_dir)
    forward = rows.where("frame >= user_id % 20 AND (frame + user_id) % 9 <> 0")
    return forward, rows.where("frame <= user_id % 20 + 2").withColumn("area", F.col("area") + 1000)


@query("SELECT user_id, frame, area FROM merged", d.DAYS, _HALVES)
def merge_tracks(spark, sf_dir):
    return tracks.merged(*_halves(spark, sf_dir), ["user_id", "frame"], ["area"], 28)


@query("SELECT user_id, frame FROM spine WHERE frame < 28 AND (user_id, frame) NOT IN (SELECT user_id, frame FROM forward UNION ALL SELECT user_id, frame FROM reverse)", d.DAYS, _HALVES)
def coverage_gaps(spark, sf_dir):
    forward, reverse = _halves(spark, sf_dir)
    return tracks.coverage_gaps(forward.unionByName(reverse), d.days(spark, sf_dir), ["user_id"], 28)


_P = f"p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_clamp()} FROM boxes)"
_T = "t AS (SELECT *, greatest(x1, least(x1 + l_linenumber, 853)) AS tx1, y1 AS ty1, greatest(x2 - l_suppkey % 9, greatest(x1, least(x1 + l_linenumber, 853)) + 1) AS tx2, y2 AS ty2 FROM p)"
_M = (
    "m AS (SELECT *, CAST(greatest(1, (x2 - x1) * (y2 - y1)) AS DOUBLE) AS pa, CAST((tx2 - tx1) * (ty2 - ty1) AS DOUBLE) AS ta, floor((tx2 - tx1) * (ty2 - ty1) * (l_partkey % 10) / 10.0) AS px,"
    " CAST(greatest(0, least(x2, tx2) - greatest(x1, tx1)) * (y2 - y1) AS DOUBLE) AS inter FROM t)"
)


@query(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_round('px / pa', 6)} AS mask_share_of_prompt, {_round('px / ta', 6)} AS mask_fill_of_tight, {_round('ta / pa', 6)} AS area_ratio, {_round('inter / (pa + ta - inter)', 4)} AS box_shift_iou,"
    f" (tx1 <= 0 OR ty1 <= 0 OR tx2 >= 854 OR ty2 >= 480) AS touches_frame_edge, {_round('ta / pa', 6)} < 0.25 AS suspect_shrink, {_round('px / ta', 6)} < 0.15 AS suspect_thin FROM m",
    d.BOXES, _P, _T, _M,
)
def tighten_diag(spark, sf_dir):
    from framewright.functions.geometry import clamp_box

    w, h = F.lit(d.WIDTH), F.lit(d.HEIGHT)
    rows = d.boxes(spark, sf_dir).select(*d.KEYS, *clamp_box(Box.of(), w, h).columns())
    tx1 = F.greatest(F.col("x1"), F.least(F.col("x1") + F.col("l_linenumber"), F.lit(853)))
    rows = rows.withColumns({"tx1": tx1, "ty1": F.col("y1"), "ty2": F.col("y2")}).withColumn("tx2", F.greatest(F.col("x2") - F.col("l_suppkey") % 9, F.col("tx1") + 1))
    pixels = F.floor((F.col("tx2") - F.col("tx1")) * (F.col("ty2") - F.col("ty1")) * (F.col("l_partkey") % 10) / 10.0)
    prompt = Box.of().each(lambda c: c.cast("double"))
    got = tracks.tighten_diagnostics(rows, prompt, Box.of("t"), pixels, w, h)
    names = ["mask_share_of_prompt", "mask_fill_of_tight", "area_ratio", "box_shift_iou", "touches_frame_edge", "suspect_shrink", "suspect_thin"]
    return got.select(*d.KEYS, *names)
