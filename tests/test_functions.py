"""Column functions against literals and small Python specifications."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.functions import canvas, geometry, ids
from framewright.functions.geometry import Box
from framewright.functions.rounding import round_exact
from framewright.functions.text import strip_indices, subject_noun, three_decimals

QUIET = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lits(*values):
    return Box(*(F.lit(float(v)) for v in values))


def test_round_exact_is_pythons_round(spark):
    rng = random.Random(3)
    values = [rng.uniform(-50, 50) for _ in range(3000)] + [k / 8 for k in range(-80, 80)] + [rng.randrange(10**7) / 10**6 + 5e-7 for _ in range(2000)] + [2.675, 1.005, 0.5, 1.5, 2.5]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (2, 4, 5, 6):
        got = [r.y for r in frame.select(round_exact(F.col("x"), digits).alias("y")).collect()]
        assert got == [round(v, digits) for v in values]


def test_three_decimals_are_pythons(spark):
    rng = random.Random(5)
    values = [161300 / 200000 - 0.5, 13900 / 200000 - 0.5, 0.0625, -0.0625, 0.9995, 1.0005, -0.0, 0.0, -0.0001, 5e-324, math.nan, math.inf, -math.inf]
    values += [rng.uniform(-2, 2) for _ in range(2000)] + [rng.randrange(-2000, 2000) / 1000 + 5e-4 for _ in range(2000)] + [k / 16 for k in range(-80, 80)]
    values += [s * rng.random() * 2.0**e for e in range(1, 63) for s in (-1, 1) for _ in range(20)] + [2.0**40 + 0.0625, 2.0**60, 1024 - 2.0**63, 1e22]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r.y for r in frame.select(three_decimals(F.col("x")).alias("y")).collect()] == [f"{v:.3f}" for v in values]
    assert one(spark, three_decimals(F.lit(None).cast("double"))) == ("-",)


@pytest.mark.parametrize(
    "box,want",
    [((10.4, 20.6, 30.5, 39.49), (10, 21, 30, 39)), ((30, 20, 30, 20), (30, 20, 31, 21)), ((500, 500, 600, 600), (99, 49, 100, 50))],
)
def test_clamp_box(spark, box, want):
    assert one(spark, *geometry.clamp_box(lits(*box), F.lit(100), F.lit(50))) == want


def test_clamp_box_of_no_box_is_null(spark):
    assert one(spark, *geometry.clamp_box(Box(F.lit(None).cast("double"), F.lit(1.0), F.lit(2.0), F.lit(3.0)), F.lit(9), F.lit(9))) == (None,) * 4


def test_fraction_iou_and_degenerate(spark):
    assert one(spark, geometry.box_fraction(lits(0, 0, 200, 50), F.lit(100), F.lit(50))) == (2.0,)
    assert one(spark, geometry.iou(lits(1, 1, 1, 1), lits(2, 2, 2, 2))) == (None,)
    assert one(spark, geometry.iou(lits(0, 0, 10, 10), lits(5, 0, 15, 10))) == (round(50 / 150, 4),)
    assert one(spark, geometry.is_degenerate(lits(0, 0, 1.9, 9)), geometry.is_degenerate(lits(0, 0, 2, 2))) == (True, False)


def test_resolve_box(spark):
    size = F.lit(1920), F.lit(1080)
    assert one(spark, *geometry.resolve_box(lits(100, 50, 300, 200), F.lit("annotation"), *size)) == (250.0, 125.0, 750.0, 500.0)
    assert one(spark, *geometry.resolve_box(lits(300, 200, 100, 50), F.lit("frame"), *size)) == (100.0, 50.0, 300.0, 200.0)
    for bad in ("768", "Frame", "", None):
        with pytest.raises(Exception, match="unknown box space"):
            one(spark, *geometry.resolve_box(lits(1, 2, 3, 4), F.lit(bad).cast("string"), *size))


@pytest.mark.parametrize("value,want", [(853.33, 854), (853, 854), (852, 852), (426.5, 426), (427.5, 428), (0.4, 2), (1.0, 2)])
def test_snap(spark, value, want):
    assert one(spark, geometry.snap(F.lit(float(value)))) == (want,)


@pytest.mark.parametrize("size,want", [((1920, 1080), (854, 480)), ((1280, 720), (854, 480)), ((1440, 1080), (640, 480)), ((641, 480), (641, 480))])
def test_stored_dims(spark, size, want):
    assert one(spark, *geometry.stored_dims(*map(F.lit, size))) == want


def test_storage_plan_flags(spark):
    plan = geometry.storage_plan(F.lit(1080), F.lit(1920))
    got = spark.range(1).select(*(c.alias(n) for n, c in plan.items())).first()
    assert (got.width, got.height, got.crop_discard_excessive) == (270, 480, True) and got.train_discard_height > 0.6
    with pytest.raises(Exception, match="positive"):
        one(spark, *geometry.stored_dims(F.lit(0), F.lit(5)))


def test_dilate_and_pinned(spark):
    size = F.lit(1000), F.lit(1000)
    assert one(spark, *geometry.dilate_box(lits(100, 100, 200, 200), *size)) == (90, 90, 210, 210)
    tight = Box(*map(F.lit, (100, 100, 200, 200)))
    assert one(spark, geometry.pinned_edges(tight, tight, F.lit(500), F.lit(500)))[0] == ["left", "top", "right", "bottom"]
    whole = Box(*map(F.lit, (0, 0, 500, 500)))
    assert one(spark, geometry.pinned_edges(whole, whole, F.lit(500), F.lit(500)))[0] == []
    for offset, pinned in ((2, True), (3, False)):
        inner = Box(*map(F.lit, (100 + offset, 150, 150, 150)))
        assert ("left" in one(spark, geometry.pinned_edges(inner, tight, F.lit(500), F.lit(500)))[0]) is pinned


def test_plausible(spark):
    reference = lits(0, 0, 100, 100)
    assert one(spark, geometry.is_plausible(lits(0, 0, 20, 20), reference), geometry.is_plausible(lits(0, 0, 70, 70), reference)) == (False, True)


def test_is_box(spark):
    assert one(spark, *(geometry.is_box(F.lit(v).cast("array<double>")) for v in ([1.0, 2.0, 3.0, 4.0], [1.0], None))) == (True, False, False)


@pytest.mark.parametrize("size,want", [((1280, 720), (1288, 728)), ((1920, 1080), (1316, 728)), ((854, 480), (840, 476)), ((10, 10), (56, 56))])
def test_smart_resize(spark, size, want):
    assert one(spark, *canvas.smart_resize(*map(F.lit, size))) == want


def test_smart_resize_refuses(spark):
    for size in ((0, 5), (1000, 4)):
        with pytest.raises(Exception, match="ratio"):
            one(spark, *canvas.smart_resize(*map(F.lit, size)))


def test_canvas_round_trip_and_names(spark):
    for name in canvas.CANVASES:
        back = canvas.unmap_box(canvas.map_box(lits(1, 2, 30, 40), name, F.lit(1920), F.lit(1080)), name, F.lit(1920), F.lit(1080))
        assert all(math.isclose(a, b) for a, b in zip(one(spark, *back), (1, 2, 30, 40)))
    with pytest.raises(KeyError, match="H_768_long"):
        canvas.canvas("none")
    assert one(spark, *canvas.map_box(lits(0, 0, 1000, 1000), "H_norm1000", F.lit(1920), F.lit(1080))) == (0.0, 0.0, 1920.0, 1080.0)


def test_ids(spark):
    clip = F.lit("0047e41c_x_35.4_43.7")
    assert one(spark, ids.clip_source(clip), ids.clip_start(clip), ids.clip_end(clip)) == ("0047e41c_x", 35.4, 43.7)
    assert one(spark, *(ids.source_of(F.lit(x)) for x in ("a_1_2", "a_1", "a", "a_b_1_2", ""))) == ("a", "a", "a", "a_b", "")
    assert one(spark, ids.url_video_id(F.lit("http://h/watch?v=abc&t=1")), ids.url_video_id(F.lit("http://h/"))) == ("abc", None)
    assert one(spark, ids.sample_id(F.lit("u"), F.lit(12.46875))) == ("u_w000012469" if round(12468.75) == 12469 else "u_w000012468",)
    assert one(spark, ids.sample_id(F.lit("u"), F.lit(12345678901.0))) == ("u_w12345678901000",)
    assert one(spark, ids.seed_index(F.lit(15.0), F.lit(12.46875))) == (40,)
    with pytest.raises(Exception):
        one(spark, ids.clip_start(F.lit("nothing")))


def test_shards_are_disjoint_and_complete(spark):
    import hashlib

    sources = [f"s{i}" for i in range(300)]
    frame = spark.createDataFrame([(s,) for s in sources], "s string")
    for n in (2, 3, 8, 16):
        got = {r.s: r.k for r in frame.select("s", ids.shard_of(F.col("s"), n).alias("k")).collect()}
        assert got == {s: int.from_bytes(hashlib.sha256(f"shard:{s}".encode()).digest()[:8], "big") % n for s in sources}


@pytest.mark.parametrize(
    "phrase,want",
    [("man with short dark hair and glasses", "man"), ("young woman with long, wavy hair", "young woman"), ("with a hat", "with a hat"), (None, ""), ("Red car. Near. it", "Red car."), (" a,b  ", "a b")],
)
def test_subject_noun(spark, phrase, want):
    assert one(spark, subject_noun(F.lit(phrase).cast("string"))) == (want,)


def test_strip_indices(spark):
    def picks(total, seed):
        return one(spark, strip_indices(F.lit(total), F.lit(seed).cast("int")))[0]

    assert picks(81, None) == sorted({round(i * 80 / 7) for i in range(8)})
    assert picks(5, 2) == [0, 1, 2, 3, 4] and picks(0, None) == []
    assert 33 in picks(81, 33) and 200 not in picks(81, 200)


@QUIET
@given(st.lists(st.tuples(*[st.floats(-500, 1500) for _ in range(4)]), min_size=1, max_size=30))
def test_clamp_box_like_its_specification(spark, boxes):
    def spec(b, w=640, h=360):
        x1, y1 = max(0, min(round(b[0]), w - 1)), max(0, min(round(b[1]), h - 1))
        return (x1, y1, max(x1 + 1, min(round(b[2]), w)), max(y1 + 1, min(round(b[3]), h)))

    frame = spark.createDataFrame(boxes, "x1 double, y1 double, x2 double, y2 double")
    got = [tuple(r) for r in frame.select(*geometry.clamp_box(Box.of(), F.lit(640), F.lit(360))).collect()]
    assert got == [spec(b) for b in boxes]
