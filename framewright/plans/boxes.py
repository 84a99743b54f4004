"""Queries over boxes and frame sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import canvas as cv
from framewright.functions import geometry as g
from framewright.functions.rounding import round_exact
from framewright.plans import derived as d
from framewright.plans.registry import joined, query

_K = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _w():
    return F.lit(d.WIDTH), F.lit(d.HEIGHT)


def _round(x: str, digits: int) -> str:
    # printed decimals are those of the binary value; x * 10^digits may fall on a half that x misses
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


def _clamped(x1="x1", y1="y1", x2="x2", y2="y2", w="854", h="480") -> tuple[str, ...]:
    a, b = f"greatest(0, least(CAST(round_even({x1}, 0) AS INTEGER), {w} - 1))", f"greatest(0, least(CAST(round_even({y1}, 0) AS INTEGER), {h} - 1))"
    return a, b, f"greatest({a} + 1, least(CAST(round_even({x2}, 0) AS INTEGER), {w}))", f"greatest({b} + 1, least(CAST(round_even({y2}, 0) AS INTEGER), {h}))"


def _clamp(*corners_and_size: str) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in zip(("x1", "y1", "x2", "y2"), _clamped(*corners_and_size)))


@query(f"SELECT {_K}, {_clamp()} FROM boxes", d.BOXES)
def clamp_box(spark, sf_dir):
    return d.boxes(spark, sf_dir).select(*d.KEYS, *g.clamp_box(g.Box.of(), *_w()).columns())


_CLIP = "least(greatest(least(x1, x2), 0.0::DOUBLE), 854.0::DOUBLE) AS x1, least(greatest(least(y1, y2), 0.0::DOUBLE), 480.0::DOUBLE) AS y1, least(greatest(greatest(x1, x2), 0.0::DOUBLE), 854.0::DOUBLE) AS x2, least(greatest(greatest(y1, y2), 0.0::DOUBLE), 480.0::DOUBLE) AS y2"
_CLIPPED = f"clipped AS (SELECT {_K}, {_CLIP} FROM (SELECT {_K}, x2 AS x1, y1, x1 AS x2, y2 FROM boxes))"


def _swapped(spark, sf_dir):
    rows = d.boxes(spark, sf_dir)
    return rows.select(*d.KEYS, F.col("x2").alias("x1"), "y1", F.col("x1").alias("x2"), "y2")


@query(f"SELECT * FROM clipped", d.BOXES, _CLIPPED)
def clamp_to_frame(spark, sf_dir):
    return _swapped(spark, sf_dir).select(*d.KEYS, *g.clamp_to_frame(g.Box.of(), *_w()).columns())


@query("SELECT l_orderkey, x1, y1, x2, y2 FROM clipped WHERE x2 - x1 < 2.0 OR y2 - y1 < 2.0", d.BOXES, _CLIPPED)
def degenerate_filter(spark, sf_dir):
    rows = _swapped(spark, sf_dir).select(*d.KEYS, *g.clamp_to_frame(g.Box.of(), *_w()).columns())
    return rows.where(g.is_degenerate(g.Box.of())).select("l_orderkey", "x1", "y1", "x2", "y2")


@query(f"SELECT {_K}, {_round('(greatest(0.0, x2 - x1) * greatest(0.0, y2 - y1)) / CAST(854 * 480 AS DOUBLE)', 5)} AS fraction FROM boxes", d.BOXES)
def box_fraction(spark, sf_dir):
    return d.boxes(spark, sf_dir).select(*d.KEYS, g.box_fraction(g.Box.of(), *_w()).alias("fraction"))


_I = "(greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1)))"
_A = "(greatest(0.0, {0}.x2 - {0}.x1) * greatest(0.0, {0}.y2 - {0}.y1))"
_IOU = f"CASE WHEN {_A.format('a')} + {_A.format('b')} - {_I} > 0 THEN {_round(f'{_I} / ({_A.format('a')} + {_A.format('b')} - {_I})', 4)} END"


@query(f"SELECT a.l_orderkey, a.l_linenumber AS i, a.l_partkey AS pa, b.l_linenumber AS j, b.l_partkey AS pb, {_IOU} AS iou FROM boxes a JOIN boxes b ON a.l_orderkey = b.l_orderkey AND (a.l_linenumber < b.l_linenumber)", d.BOXES)
def box_iou(spark, sf_dir):
    rows = d.boxes(spark, sf_dir)
    a = rows.select("l_orderkey", F.col("l_linenumber").alias("i"), F.col("l_partkey").alias("pa"), *g.Box.of().columns("a_"))
    b = rows.select("l_orderkey", F.col("l_linenumber").alias("j"), F.col("l_partkey").alias("pb"), *g.Box.of().columns("b_"))
    return a.join(b, "l_orderkey").where("i < j").select("l_orderkey", "i", "pa", "j", "pb", g.iou(g.Box.of("a_"), g.Box.of("b_")).alias("iou"))


@query(f"SELECT {_K}, x1 * (854 / 1920.0::DOUBLE) AS x1, y1 * (480 / 1080.0::DOUBLE) AS y1, x2 * (854 / 1920.0::DOUBLE) AS x2, y2 * (480 / 1080.0::DOUBLE) AS y2 FROM boxes", d.BOXES)
def scale_box(spark, sf_dir):
    return d.boxes(spark, sf_dir).select(*d.KEYS, *g.scale_box(g.Box.of(), F.lit(1920), F.lit(1080), *_w()).columns())


_S = "CASE WHEN l_linenumber % 2 = 0 THEN 1.0::DOUBLE ELSE 854 / 768.0::DOUBLE END"


@query(f"SELECT {_K}, {_CLIP} FROM (SELECT {_K}, x1 * {_S} AS x1, y1 * {_S} AS y1, x2 * {_S} AS x2, y2 * {_S} AS y2 FROM boxes)", d.BOXES)
def resolve_box(spark, sf_dir):
    space = F.when(F.col("l_linenumber") % 2 == 0, "frame").otherwise("annotation")
    return d.boxes(spark, sf_dir).select(*d.KEYS, *g.resolve_box(g.Box.of(), space, *_w()).columns())


@query(f"SELECT {_K}, {_clamp('x1 - (x2 - x1) * 0.15', 'y1 - (y2 - y1) * 0.15', 'x2 + (x2 - x1) * 0.15', 'y2 + (y2 - y1) * 0.15')} FROM boxes", d.BOXES)
def dilate_box(spark, sf_dir):
    return d.boxes(spark, sf_dir).select(*d.KEYS, *g.dilate_box(g.Box.of(), *_w(), step=0.15).columns())


@query(
    f"SELECT {_K}, array_to_string(list_filter([CASE WHEN l_linenumber % 4 <= 2 AND p.x1 > 0 THEN 'left' END, CASE WHEN l_partkey % 4 <= 2 AND p.y1 > 0 THEN 'top' END, CASE WHEN l_suppkey % 4 <= 2 AND p.x2 < 854 THEN 'right' END,"
    f" CASE WHEN l_orderkey % 4 <= 2 AND p.y2 < 480 THEN 'bottom' END], lambda x: x IS NOT NULL), ',') AS edges FROM (SELECT {_K}, {_clamp()} FROM boxes) p",
    d.BOXES,
)
def pinned_edges(spark, sf_dir):
    rows = d.boxes(spark, sf_dir).select(*d.KEYS, *g.clamp_box(g.Box.of(), *_w()).columns())
    p = g.Box.of()
    tight = g.Box(p.x1 + F.col("l_linenumber") % 4, p.y1 + F.col("l_partkey") % 4, p.x2 - F.col("l_suppkey") % 4, p.y2 - F.col("l_orderkey") % 4)
    return rows.select(*d.KEYS, joined(g.pinned_edges(tight, p, *_w())).alias("edges"))


@query("SELECT l_orderkey, l_partkey, x1, y1, x2, y2 FROM boxes WHERE greatest(0.0, x2 - x1) * greatest(0.0, y2 - y1) >= greatest(1.0, 200.0 * (l_suppkey * 3)) * 0.3", d.BOXES)
def plausible_filter(spark, sf_dir):
    reference = g.Box(F.lit(0.0), F.lit(0.0), F.lit(200.0), (F.col("l_suppkey") * 3).cast("double"))
    return d.boxes(spark, sf_dir).where(g.is_plausible(g.Box.of(), reference)).select("l_orderkey", "l_partkey", "x1", "y1", "x2", "y2")


# ---- canvases and storage geometry over frame sizes ----

_RESIZED = (
    "near AS (SELECT *, round_even(w / 28.0::DOUBLE, 0) * 28.0::DOUBLE AS nw, round_even(h / 28.0::DOUBLE, 0) * 28.0::DOUBLE AS nh FROM sizes),"
    " resized AS (SELECT p_partkey, w, h, CAST(CASE WHEN nw * nh > 1003520 THEN floor(w / sqrt(CAST(w AS DOUBLE) * h / 1003520.0::DOUBLE) / 28.0::DOUBLE) * 28 WHEN nw * nh < 3136 THEN ceil(w * sqrt(3136.0::DOUBLE / (CAST(w AS DOUBLE) * h)) / 28.0::DOUBLE) * 28 ELSE nw END AS INTEGER) AS cw,"
    " CAST(CASE WHEN nw * nh > 1003520 THEN floor(h / sqrt(CAST(w AS DOUBLE) * h / 1003520.0::DOUBLE) / 28.0::DOUBLE) * 28 WHEN nw * nh < 3136 THEN ceil(h * sqrt(3136.0::DOUBLE / (CAST(w AS DOUBLE) * h)) / 28.0::DOUBLE) * 28 ELSE nh END AS INTEGER) AS ch FROM near)"
)


@query("SELECT p_partkey, cw AS width, ch AS height FROM resized", d.SIZES, _RESIZED)
def smart_resize(spark, sf_dir):
    w, h = cv.smart_resize(F.col("w"), F.col("h"))
    return d.sizes(spark, sf_dir).select("p_partkey", w.alias("width"), h.alias("height"))


_SCALES = (
    "scales AS (SELECT p_partkey, w, h, unnest(['H_768_long','H_1024_long','H_832_iso','H_832x480_aniso','H_y_anchored','H_norm1000','H_qwen_smart']) AS canvas,"
    " unnest([greatest(w, h) / 768.0::DOUBLE, greatest(w, h) / 1024.0::DOUBLE, w / 832.0::DOUBLE, w / 832.0::DOUBLE, h / (768.0::DOUBLE * h / greatest(w, h)), w / 1000.0::DOUBLE, w / CAST(cw AS DOUBLE)]) AS sx,"
    " unnest([greatest(w, h) / 768.0::DOUBLE, greatest(w, h) / 1024.0::DOUBLE, w / 832.0::DOUBLE, h / 480.0::DOUBLE, h / (768.0::DOUBLE * h / greatest(w, h)), h / 1000.0::DOUBLE, h / CAST(ch AS DOUBLE)]) AS sy FROM resized)"
)


def _mapped(spark, sf_dir, f, digits):
    box = g.Box(F.lit(10.0), F.lit(20.0), F.lit(300.0), F.lit(400.0))
    each = F.array(*(F.struct(F.lit(name).alias("canvas"), *f(box, name).columns()) for name in cv.CANVASES))
    rows = d.sizes(spark, sf_dir).select("p_partkey", F.inline(each))
    # rounded after the canvases are rows, so that the rounding is generated once
    return rows.select("p_partkey", "canvas", *g.Box.of().each(lambda c: round_exact(c, digits)).columns())


@query(
    f"SELECT p_partkey, canvas, {_round('10.0 * sx', 4)} AS x1, {_round('20.0 * sy', 4)} AS y1, {_round('300.0 * sx', 4)} AS x2, {_round('400.0 * sy', 4)} AS y2 FROM scales",
    d.SIZES, _RESIZED, _SCALES,
)
def canvas_map(spark, sf_dir):
    return _mapped(spark, sf_dir, lambda box, name: cv.map_box(box, name, F.col("w"), F.col("h")), 4)


@query("SELECT p_partkey, canvas, 10.0::DOUBLE AS x1, 20.0::DOUBLE AS y1, 300.0::DOUBLE AS x2, 400.0::DOUBLE AS y2 FROM scales", d.SIZES, _RESIZED, _SCALES)
def canvas_roundtrip(spark, sf_dir):
    def there_and_back(box, name):
        w, h = F.col("w"), F.col("h")
        return cv.unmap_box(cv.map_box(box, name, w, h), name, w, h)

    return _mapped(spark, sf_dir, there_and_back, 6)


@query(
    "SELECT canvas, count(*) AS n, count(*) FILTER (x_out) AS over_right, count(*) FILTER (y_out) AS over_bottom FROM (SELECT s.canvas, b.x2 * s.sx > s.w + 1e-6 AS x_out, b.y2 * s.sy > s.h + 1e-6 AS y_out FROM boxes b JOIN scales s ON s.p_partkey = b.l_partkey) GROUP BY canvas",
    d.SIZES, _RESIZED, _SCALES, d.BOXES,
)
def canvas_compare(spark, sf_dir):
    rows = d.boxes(spark, sf_dir).join(d.sizes(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    w, h = F.col("w"), F.col("h")
    # all canvases are counted in one pass, and one row is turned into seven
    counts = [F.count("*").alias("n")]
    for k, name in enumerate(cv.CANVASES):
        mapped = cv.map_box(g.Box.of(), name, w, h)
        counts += [F.count_if(mapped.x2 > w + 1e-6).alias(f"x{k}"), F.count_if(mapped.y2 > h + 1e-6).alias(f"y{k}")]
    each = F.array(*(F.struct(F.lit(name).alias("canvas"), "n", F.col(f"x{k}").alias("over_right"), F.col(f"y{k}").alias("over_bottom")) for k, name in enumerate(cv.CANVASES)))
    return rows.agg(*counts).where("n > 0").select(F.inline(each))


_STORED = (
    "stored AS (SELECT p_partkey, w, h, CASE WHEN h <= 480 THEN w ELSE CAST(greatest(1, floor(w * (480.0::DOUBLE / h) / 2.0::DOUBLE + 0.5)) AS INTEGER) * 2 END AS sw,"
    " CASE WHEN h <= 480 THEN h ELSE CAST(greatest(1, floor(h * (480.0::DOUBLE / h) / 2.0::DOUBLE + 0.5)) AS INTEGER) * 2 END AS sh FROM sizes),"
    " cropped AS (SELECT *, greatest(832.0::DOUBLE / sw, 480.0::DOUBLE / sh) AS s, CAST(round_even(sw * greatest(832.0::DOUBLE / sw, 480.0::DOUBLE / sh), 0) AS INTEGER) AS rw, CAST(round_even(sh * greatest(832.0::DOUBLE / sw, 480.0::DOUBLE / sh), 0) AS INTEGER) AS rh FROM stored),"
    " lost AS (SELECT *, round_even(greatest(0.0, (rw - 832) / CAST(rw AS DOUBLE)) * 1e6, 0) / 1e6 AS dw, round_even(greatest(0.0, (rh - 480) / CAST(rh AS DOUBLE)) * 1e6, 0) / 1e6 AS dh FROM cropped)"
)


@query("SELECT p_partkey, sw AS width, sh AS height FROM stored", d.SIZES, _STORED)
def stored_dims(spark, sf_dir):
    w, h = g.stored_dims(F.col("w"), F.col("h"))
    return d.sizes(spark, sf_dir).select("p_partkey", w.alias("width"), h.alias("height"))


@query(
    "SELECT p_partkey, w AS source_width, h AS source_height, sw AS width, sh AS height, 832 AS target_width, 480 AS target_height, (sw <> w OR sh <> h) AS scaled, round_even(sh / CAST(h AS DOUBLE) * 1e6, 0) / 1e6 AS scale,"
    " round_even(s * 1e6, 0) / 1e6 AS train_crop_scale, dw AS train_discard_width, dh AS train_discard_height, (dw > 0.2 OR dh > 0.2) AS crop_discard_excessive FROM lost",
    d.SIZES, _STORED,
)
def storage_plan(spark, sf_dir):
    return d.sizes(spark, sf_dir).select("p_partkey", *(c.alias(n) for n, c in g.storage_plan(F.col("w"), F.col("h")).items()))


@query("SELECT CASE WHEN h > w THEN 'portrait' ELSE 'landscape' END AS shape, count(*) AS n, count(*) FILTER (dw > 0.2 OR dh > 0.2) AS flagged FROM lost GROUP BY 1", d.SIZES, _STORED)
def discard_funnel(spark, sf_dir):
    plan = g.storage_plan(F.col("w"), F.col("h"))
    rows = d.sizes(spark, sf_dir).select(F.when(F.col("h") > F.col("w"), "portrait").otherwise("landscape").alias("shape"), plan["crop_discard_excessive"].alias("f"))
    return rows.groupBy("shape").agg(F.count("*").alias("n"), F.count_if("f").alias("flagged"))
