"""Operators on small inputs: selection, windows, un-nesting, pools, gate, tracks, manifests, rasters, sources, streams."""

import hashlib
import io
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions.geometry import Box
from framewright.operators import coverage, gate, manifests, models, planner, pool, raster, select, stages, subjects, tracks, unnest
from framewright.sources import jsonl, storage, tables
from framewright.streaming import incremental


# ---- selection ----


def test_one_per_source_does_not_depend_on_order(spark):
    rows = [(f"s{i % 7}_{i}_{i + 5}", i) for i in range(100)]
    schema = "video_id string, n int"
    a = {tuple(r) for r in select.one_per_source(spark.createDataFrame(rows, schema), ties=["n"]).collect()}
    b = {tuple(r) for r in select.one_per_source(spark.createDataFrame(rows[::-1], schema).repartition(5), ties=["n"]).collect()}
    assert a == b and len(a) == 7


def test_in_shard(spark):
    rows = spark.createDataFrame([(f"s{i}",) for i in range(50)], "source string")
    parts = [{r.source for r in select.in_shard(rows, k, 4).collect()} for k in range(4)]
    assert sum(map(len, parts)) == 50 == len(set().union(*parts))
    assert select.in_shard(rows, 0, 1).count() == 50
    for bad in ((0, 0), (4, 4), (-1, 4)):
        with pytest.raises(ValueError):
            select.in_shard(rows, *bad)


def test_considered_prefix(spark):
    rows = spark.createDataFrame([(k, k % 3 == 0) for k in range(30)], "key int, ok boolean")
    assert select.considered_prefix(rows, F.col("ok"), "key", 3).count() == 7
    assert select.considered_prefix(rows, F.col("ok"), "key", 99).count() == 30
    assert select.considered_prefix(rows, F.col("ok"), "key", None).count() == 30


def test_upsert_last_layer_wins(spark):
    layer = lambda name, keys: spark.createDataFrame([(k, name, i) for i, k in enumerate(keys)], "key int, made string, pos int")
    got = {r.key: r.made for r in select.upsert("key", "pos", layer("a", [1, 2, 3]), layer("b", [2, 3]), layer("c", [3])).collect()}
    assert got == {1: "a", 2: "b", 3: "c"}


def test_pending(spark):
    rows = spark.createDataFrame([(k,) for k in range(4)], "k int")
    markers = spark.createDataFrame([(0, "passed"), (1, "failed"), (2, "rejected")], "k int, status string")
    assert {r.k for r in select.pending(rows, markers, "k").collect()} == {1, 3}
    assert select.pending(rows, markers, "k", force=True).count() == 4


# ---- windows ----


def spec_window(start, end, seeds, length):
    if end - start < length - 1e-9:
        return None
    low, high = start, max(end - length, start)
    clamp = lambda v: min(max(v, low), high)
    options = []
    for w in {low, high, *map(clamp, seeds), *(clamp(t - length) for t in seeds)}:
        covered = [i for i, t in enumerate(seeds) if w - 1e-9 <= t <= w + length + 1e-9]
        if covered:
            options.append((-len(covered), covered))
    if not options:
        return None
    covered = min(options)[1]
    first, last = min(seeds[i] for i in covered), max(seeds[i] for i in covered)
    near = max(low, last - length)
    far = max(min(high, first), near)
    return min(max((first + last) / 2 - length / 2, near), far), covered, [i for i in range(len(seeds)) if i not in covered]


def test_window_literals(spark):
    rows = [(0.0, 10.0, [1.0, 4.0, 9.0]), (10.0, 20.0, [15.0]), (0.0, 5.0, [1.0]), (0.0, 10.0, []), (0.0, 10.0, [50.0])]
    got = coverage.with_window(spark.createDataFrame(rows, "start double, end double, seeds array<double>")).collect()
    assert [(r.window_start, r.covered, r.dropped) for r in got] == [(0.0, [0, 1], [2]), (12.46875, [0], []), (None, None, None), (None, None, None), (None, None, None)]


def test_window_like_its_specification(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(300):
        start, size = rng.choice([0.0, 3.5, 20.25]), rng.choice([5.0, 5.0625, 6.0, 9.5, 30.0])
        rows.append((start, start + size, [round(rng.uniform(start - 1, start + size + 1), 2) for _ in range(rng.randrange(6))]))
    got = coverage.with_window(spark.createDataFrame(rows, "start double, end double, seeds array<double>")).collect()
    for r in got:
        want = spec_window(r.start, r.end, r.seeds, 5.0625)
        assert ((r.window_start, r.covered, r.dropped) if r.covered is not None else None) == want


# ---- annotations ----


def pair(clip, frame="0.5", targets=1, refs=1, ref="r_0_10", box=None):
    t = {"vid": clip, "frame_idx": frame, "bbox_loc": [1, 2, 3, 4], "bbox_cls": "c"}
    r = {"vid": ref, "frame_idx": 0.25, "bbox_loc": box or [[5, 6, 7.5, 8]], "scores": 0.9}
    return {"obj_from_tgt_video": [t] * targets, "refer_result": [[r]] * refs}


def test_unnest(spark):
    text = '{"a": %s, "b": %s, "a": %s, "c": %s}' % tuple(json.dumps(x) for x in (pair("v_0_9", targets=2), pair("x_0_9"), pair("v_0_9"), pair("v_0_9", refs=2)))
    got = unnest.by_phrase(spark.createDataFrame([("v_0_9", text)], "video_id string, cross_pair string")).orderBy("position").collect()
    assert [(r.position, r.phrase, r.malformed) for r in got] == [(0, "a", None), (1, "b", "target_vid_mismatch"), (2, "c", "targets=1,refs=2")]
    with pytest.raises(Exception):
        unnest.by_phrase(spark.createDataFrame([("v", "no json")], "video_id string, cross_pair string")).collect()


def test_rows_given_twice_keep_their_own_subjects(spark):
    text = json.dumps({"a": pair("s_0_9", "0.1"), "b": pair("s_0_9", "0.2")})
    other = json.dumps({"c": pair("s_0_9", "0.3")})
    meta = spark.createDataFrame([("s_0_9", "http://h?v=s", 1), ("r_0_10", "http://h?v=r", 2)], "vid string, url string, row_idx int")
    audit = spark.createDataFrame([("s", ".mp4", 1), ("r", ".mp4", 2)], "video string, ext string, row_idx int")
    rows = spark.createDataFrame([("s_0_9", text), ("s_0_9", text), ("s_0_9", other)], "video_id string, cross_pair string")
    found = planner.outcomes(rows, meta, audit)
    assert sorted([s.phrase for s in r.subjects] for r in found.collect()) == [["a", "b"], ["a", "b"], ["c"]]
    funnel = {(r.kind, r.name): r.n for r in planner.funnel(planner.counted(found)).collect()}
    assert funnel == {("total", "sources_considered"): 3, ("total", "samples"): 3, ("total", "subjects_total"): 5, ("subjects", "2"): 2, ("subjects", "1"): 1}
    none = {(r.kind, r.name): r.n for r in planner.funnel(planner.counted(found).where("false")).collect()}
    assert none == {("total", "sources_considered"): 0, ("total", "samples"): 0, ("total", "subjects_total"): 0}


def test_box_depth(spark):
    frame = spark.createDataFrame([("[1, 2, 3, 4]",), ("[[1, 2, 3, 4]]",), ("[[[1,2,3,4.5]],[[9,9,9,9]]]",)], "b string")
    assert [list(r[0]) for r in frame.select(unnest.box_of(F.col("b"))).collect()] == [[1, 2, 3, 4], [1, 2, 3, 4], [1, 2, 3, 4.5]]


def test_planner_reasons_and_dense_ids(spark):
    rows = [
        ("s1_0_4", json.dumps({"a": pair("s1_0_4")})),
        ("s2_0_9", json.dumps({"a": pair("other_0_9")})),
        ("s3_0_9", json.dumps({"a": pair("s3_0_9", "3.0")})),
        ("s4_0_9", json.dumps({"a": pair("s4_0_9")})),
        ("s5_0_9", json.dumps({"a": pair("s5_0_9", ref="nowhere_0_1")})),
        ("s6_0_9", json.dumps({"a": pair("s6_0_9", "0.1", ref="nowhere_0_1"), "b": pair("s6_0_9", "0.2"), "c": pair("s6_0_9", "0.99"), "d": pair("s6_0_9", targets=2)})),
    ]
    meta = spark.createDataFrame([(f"s{i}_0_9", f"http://h?v=id{i}", i) for i in (2, 3, 5, 6)] + [("r_0_10", "http://h?v=idr", 9)], "vid string, url string, row_idx int")
    audit = spark.createDataFrame([(f"id{i}", ".mp4", 1) for i in (2, 3, 5, 6)] + [("idr", None, 1)], "video string, ext string, row_idx int")
    got = {r.video_id: r for r in planner.outcomes(spark.createDataFrame(rows, "video_id string, cross_pair string"), meta, audit).collect()}
    assert [got[f"s{i}_0_9"].reason if i > 1 else got["s1_0_4"].reason for i in range(1, 7)] == [*planner.REASONS, None]
    spec = got["s6_0_9"]
    assert [(s.subject_id, s.phrase, s.ref_key, list(s.ref_box)) for s in spec.subjects] == [(1, "b", "videos/idr/idr", [5, 6, 7.5, 8])]
    assert [(x.phrase, x.reason) for x in spec.dropped] == [("d", "malformed_annotation"), ("c", "seed_outside_window"), ("a", "ref_bos_unresolved")]


# ---- pools ----


def test_dedupe_keeps_the_first(spark):
    rows = [(1, 0, "annotation", [100.0, 100.0, 200.0, 200.0]), (1, 1, "detector", [101.0, 100.0, 200.0, 201.0]), (1, 2, "detector", [0.0, 0.0, 10.0, 10.0]), (1, 3, "detector", None)]
    pools = spark.createDataFrame(rows, "k int, place int, origin string, box array<double>")
    got = pool.deduped(pools, ["k"], ["place"]).orderBy("place").collect()
    assert [(r.place, r.also) for r in got] == [(0, ["detector"]), (2, [])]


def test_best_pair(spark):
    def side(vectors):
        return spark.createDataFrame([(1, i, "annotation" if i == 0 else "detector", v) for i, v in enumerate(vectors)], "k int, place int, origin string, vector array<float>")

    left, right = side([[1.0, 0.0], [0.0, 1.0], None]), side([[1.0, 0.1], [0.0, 0.0]])
    got = pool.best_pair(pool.scored_pairs(left, right, ["k"]), left, right, ["k"]).first()
    assert (got.ref_index, got.seed_index, got.pairs_scored, got.ref_candidates, got.seed_candidates, got.used_detector) == (0, 0, 2, 3, 2, False)
    assert got.margin == pytest.approx(got.identity - round(0.1 / (1.01**0.5), 6), abs=1e-6)
    alone = pool.best_pair(pool.scored_pairs(side([[1.0, 0.0]]), side([[1.0, 0.0]]), ["k"]), side([[1.0, 0.0]]), side([[1.0, 0.0]]), ["k"]).first()
    assert alone.margin is None and alone.identity == 1.0
    none = pool.best_pair(pool.scored_pairs(side([None]), side([None]), ["k"]), side([None]), side([None]), ["k"]).first()
    assert (none.identity, none.pairs_scored) == (None, 0)


# ---- gate ----

RECORD = "sample_id string, subject_id int, row_idx int, identity double, pick_ref string, pick_seed string, box_ref string, box_seed string"


@pytest.mark.parametrize("identity,pick,want", [(0.2, "dis", "keep"), (0.199, "dis", "drop"), (None, "dis", "drop"), (0.99, "no_box", "drop")])
def test_decide(spark, identity, pick, want):
    ruling = gate.decide(F.lit(identity).cast("double"), F.lit(pick), F.lit("dis"), 0.2)
    assert spark.range(1).select(ruling.alias("d")).first().d.verdict == want
    with pytest.raises(ValueError):
        gate.decide(F.lit(1.0), F.lit("a"), F.lit("b"), 0.2, rule="other")


@pytest.mark.parametrize(
    "identity,want",
    [(161300 / 200000 - 0.5, "identity 0.306 >= 0.2"), (13900 / 200000 - 0.5, "identity -0.430 < 0.2"), (0.1995, "identity 0.200 < 0.2"), (0.0625, "identity 0.062 < 0.2"), (None, "no identity score")],
)
def test_decide_tells_the_score_as_its_binary_value_rounds(spark, identity, want):
    ruling = gate.decide(F.lit(identity).cast("double"), F.lit("dis"), F.lit("dis"), 0.2)
    assert spark.range(1).select(ruling.alias("d")).first().d.reason == want


def test_gate_funnel(spark):
    subjects = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "sample_id string, subject_id int")
    records = spark.createDataFrame([("a", 1, 0, 0.1, "dis", "dis", "x", "y"), ("a", 1, 1, 0.8, "dis", "dis", "x", "y"), ("a", 2, 2, 0.1, "dis", "dis", "x", "y")], RECORD)
    got = gate.funnel(gate.gate(subjects, records, 0.2, "row_idx")).first()
    assert (got.samples_in, got.samples_out, got.subjects_in, got.subjects_out, got.identity, got.no_record) == (2, 1, 3, 1, 1, 1)
    kept = gate.gate(subjects, records, 0.2, "row_idx", keep_all=True)
    assert kept.where("out").count() == 2 and kept.where("kept_anyway").count() == 1


def test_kept_without_a_box_still_drops(spark):
    subjects = spark.createDataFrame([("a", 1)], "sample_id string, subject_id int")
    records = spark.createDataFrame([("a", 1, 0, 0.9, "dis", "dis", None, "y")], RECORD)
    for keep_all in (False, True):
        got = gate.gate(subjects, records, 0.2, "row_idx", keep_all).first()
        assert (got.out, got.gate) == (False, "no_box")


# ---- tracks ----


@pytest.mark.parametrize(
    "areas,visible,low,gaps",
    [([100, 100, 3, 100], 4, 0.03, []), ([100, 0, 100], 2, 1.0, [1]), ([100, 100, 0], 2, 1.0, []), ([0, 0], 0, 0.0, [])],
)
def test_mask_stats(spark, areas, visible, low, gaps):
    got = tracks.mask_stats(spark.createDataFrame([(areas,)], "areas array<long>"), F.lit(400)).first()
    assert (got.visible_frame_count, got.area_min_ratio, got.interior_gap_frames) == (visible, low, gaps)
    assert got.full_clip_covered == (visible == len(areas))


def test_tighten_diagnostics(spark):
    none = F.lit(None).cast("int")
    d = tracks.tighten_diagnostics(spark.range(1), Box(*(F.lit(float(v)) for v in (0, 0, 10, 10))), Box(none, none, none, none), F.lit(5), F.lit(20), F.lit(20))
    assert d.select("id", "fail_reason", "tightened").first()[:] == (0, "empty mask", False)


# ---- manifests ----


@pytest.mark.parametrize("path", ["../x", "clips/../../x", "/abs", "..", "", "clips/"])
def test_unsafe_paths(spark, path):
    assert spark.range(1).select(manifests.is_safe_path(F.lit(path))).first()[0] is False
    with pytest.raises(ValueError):
        storage.check_path(path)
    with pytest.raises(Exception, match="unsafe"):
        spark.range(1).select(manifests.safe_path(F.lit(path))).collect()


@pytest.mark.parametrize("path,prefix,want", [("clips/784c_w1.mp4", "p", "p/clips/78/784c_w1.mp4"), ("x.jsonl", "p", "p/manifests/x.jsonl"), ("manifests/x.json", "", "manifests/x.json")])
def test_storage_key(spark, path, prefix, want):
    assert spark.range(1).select(manifests.storage_key(F.lit(path), prefix)).first()[0] == want


def test_required_and_space(spark):
    assert spark.range(1).select(manifests.required("x", F.lit(None).cast("string"), F.lit("b"))).first()[0] == "b"
    with pytest.raises(Exception, match="required"):
        spark.range(1).select(manifests.required("x", F.lit(None).cast("string"))).collect()
    assert spark.range(1).select(manifests.box_space(F.lit(None).cast("string")), manifests.box_space(F.lit(""))).first()[:] == ("annotation", "annotation")


def test_counts_and_split(spark):
    rows = spark.createDataFrame([("a", "passed", [1]), ("b", "failed", [2]), ("c", "passed", None)], "k string, status string, boxes array<int>")
    assert {r.status: r.n for r in manifests.status_counts(rows).collect()} == {"passed": 2, "failed": 1}
    slim, documents = manifests.split_heavy(rows, "k", ["boxes"])
    assert slim.columns == ["k", "status"] and documents.columns == ["k", "boxes"]


def test_size_summary_of_nothing(spark):
    rows = spark.createDataFrame([], "size long, flagged boolean, sample_id string")
    got = manifests.size_summary(rows, "size").first()
    assert (got.rows, got.bytes_total, got.bytes_median, got.flagged_samples) == (0, 0, 0, [])


# ---- rasters and stages ----


def flood(mask):
    """Component sizes by flood fill."""
    left, sizes = {tuple(p) for p in np.argwhere(mask)}, []
    while left:
        stack, n = [left.pop()], 0
        while stack:
            y, x = stack.pop()
            n += 1
            for p in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if p in left:
                    left.remove(p)
                    stack.append(p)
        sizes.append(n)
    return sorted(sizes)


def test_labels_like_flood_fill():
    rng = np.random.default_rng(5)
    for p in (0.2, 0.5, 0.6, 0.9):
        mask = rng.random((40, 37)) < p
        labels, sizes = raster.label(mask)
        assert sorted(sizes.tolist()) == flood(mask) and ((labels > 0) == mask).all()


def test_speckle_and_packing():
    mask = np.zeros((60, 61), bool)
    mask[5:30, 5:30] = mask[40:45, 40:45] = mask[55, 58] = True
    clean = raster.without_speckle(mask)
    assert clean[42, 42] == (25 >= 0.05 * 625) and not clean[55, 58]
    assert (raster.unpack(raster.pack(mask), 61) == mask).all()
    assert raster.mask_box(np.zeros((3, 3), bool)) is None and raster.mask_box(mask) == [5, 5, 59, 56]
    assert raster.cutout(np.zeros((60, 61, 3), np.uint8), None) is None
    assert raster.component_stats(np.zeros((2, 2), bool)) == (0, 0.0)


def test_cutouts():
    frame, mask = np.full((6, 7, 3), 9, np.uint8), np.zeros((6, 7), bool)
    assert raster.cutout_alpha(frame, mask) is None and raster.cutout_alpha(frame, None) is None
    mask[2:4, 3:6] = True
    mask[2, 3] = False
    white, alpha = raster.cutout(frame, mask), raster.cutout_alpha(frame, mask)
    assert white.shape == (2, 3, 3) and white[0, 0].tolist() == [255] * 3 and white[1, 1].tolist() == [9] * 3
    assert alpha.shape == (2, 3, 4) and alpha[..., 3].tolist() == [[0, 255, 255], [255, 255, 255]]
    assert raster.outline(mask).sum() == 5


def test_both_sides():
    frame, thing = np.zeros((40, 60, 3), np.uint8), models.RectangleSegmenter([10, 10, 30, 30])
    assert raster.tighten_both(thing, frame, [5, 5, 35, 35], frame, [12, 5, 35, 35])[2]
    assert not raster.tighten_both(thing, frame, [5, 5, 35, 35], frame, None)[2]


def test_newest_snapshot(tmp_path):
    import os

    assert models.newest_snapshot(str(tmp_path)) == str(tmp_path)
    for at, name in enumerate(("a", "b", "c")):
        (tmp_path / "snapshots" / name).mkdir(parents=True)
        os.utime(tmp_path / "snapshots" / name, (at % 2, at % 2))
    assert models.newest_snapshot(str(tmp_path)).endswith("/b")


def test_tighten_loop():
    frame = np.zeros((400, 600, 3), np.uint8)
    grown = raster.tighten(models.RectangleSegmenter([100, 100, 220, 220]), frame, [110, 110, 200, 200])
    assert grown["stop"] == "settled" and grown["tight"] == [100, 100, 220, 220] and grown["rounds"] > 0
    assert raster.tighten(models.RectangleSegmenter([0, 0, 5, 5]), frame, [300, 300, 350, 350])["stop"] == "empty"
    assert raster.tighten(models.RectangleSegmenter([0, 0, 5, 5]), frame, None)["stop"] == "degenerate"
    assert raster.tighten(models.RectangleSegmenter([0, 0, 600, 400]), frame, [100, 100, 120, 120])["stop"] == "limit"


def test_raster_queries_draw_every_order(spark, tmp_path):
    from framewright.plans import manifests as plans

    rng = random.Random(12)
    rows = [(o, n, o * 3, n, float(rng.randrange(1, 51)), rng.randrange(11) / 100, rng.randrange(9) / 100) for o in (1, 2, 7, 20, 33, 40) for n in range(1, 5)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    masks, traces = {}, {}
    for o, n, part, supp, quantity, discount, tax in rows:
        x, y = quantity * 16, discount * 4000
        box = [x, y, x + tax * 6000, y + n * 60]
        x1, y1 = max(0, min(round(box[0] / 16), 53)), max(0, min(round(box[1] / 16), 29))
        x2, y2 = max(x1 + 1, min(round(box[2] / 16), 54)), max(y1 + 1, min(round(box[3] / 16), 30))
        masks.setdefault(o, np.zeros((30, 54), bool))[y1:y2, x1:x2] = True
        got = raster.tighten(models.RectangleSegmenter([40, 20, 150, 100]), np.zeros((120, 214, 3), np.uint8), [c / 4 for c in box])
        traces[o, n, part, supp] = (got["rounds"], got["stop"], ",".join(map(str, got["tight"])) if got["tight"] else None)
    digests = {r.l_orderkey: (r.n_bytes, r.digest) for r in plans.mask_pack(spark, str(tmp_path)).collect()}
    assert digests == {o: (210, hashlib.sha256(np.packbits(raster.without_speckle(m), axis=-1).tobytes()).hexdigest()) for o, m in masks.items()}
    parts = {r.l_orderkey: (r.components, r.largest_share, r.pixels) for r in plans.mask_components(spark, str(tmp_path)).collect()}
    assert parts == {o: (*raster.component_stats(m), int(raster.without_speckle(m).sum())) for o, m in masks.items()}
    found = {tuple(r)[:4]: tuple(r)[4:] for r in plans.tighten_trace(spark, str(tmp_path)).collect()}
    assert found == traces


def test_stages(spark):
    codec = models.RawCodec()
    frames = np.zeros((6, 20, 30, 3), np.uint8)
    clips = spark.createDataFrame([("a", bytearray(codec.encode(frames)), [0, 2, 9], 30, 20), ("b", bytearray(b"junk"), [0], 30, 20)], "sample_id string, data binary, indices array<int>, width int, height int")
    got = {r.sample_id: r for r in stages.extract(clips, models.RawCodec).collect()}
    assert (got["a"].status, got["a"].frame_count, got["b"].status) == ("passed", 3, "failed")
    clip = bytearray(codec.encode(frames))
    reference = bytearray(codec.encode(frames[0]))
    rows = [("a", clip, 1, 2, [2.0, 2.0, 9.0, 9.0], reference, [1.0, 1.0, 9.0, 9.0]), ("a", clip, 2, 99, [2.0, 2.0, 9.0, 9.0], reference, [1.0, 1.0, 9.0, 9.0]), ("c", clip, 1, 2, [2.0, 2.0, 3.0, 3.0], reference, [1.0, 1.0, 9.0, 9.0])]
    samples = spark.createDataFrame(rows, "sample_id string, clip binary, subject_id int, seed_frame int, seed_box array<double>, reference binary, ref_box array<double>")
    done = stages.segment(samples, models.RawCodec, Thing, models.HeldTracker)
    assert {(r.sample_id, r.subject_id): (r.status, r.reason) for r in done.collect()} == {("a", 1): ("passed", None), ("a", 2): ("dropped", "seed_frame_out_of_range"), ("c", 1): ("dropped", "degenerate_seed_box")}
    assert {r.sample_id: r.status for r in stages.sample_status(done).collect()} == {"a": "passed", "c": "rejected"}


class Thing(models.RectangleSegmenter):
    def __init__(self):
        super().__init__([0, 0, 8, 8])


# ---- sources ----


def test_jsonl(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"k": 1, "v": null}\n\n{"k": 2, "v": "x"}\n')
    assert jsonl.read(spark, str(good), "k int, v string", "k").count() == 2
    for text in ('{"k": 1}\nnot json\n', '{"v": "x"}\n'):
        bad = tmp_path / f"bad{len(text)}.jsonl"
        bad.write_text(text)
        with pytest.raises(Exception):
            jsonl.read(spark, str(bad), "k int, v string", "k").collect()
    assert jsonl.read_or_empty(spark, str(tmp_path / "none.jsonl"), "k int").count() == 0
    jsonl.write(spark.createDataFrame([(2, None), (1, "a")], "o int, v string"), str(tmp_path / "out"), order="o")
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"v":"a"}', '{"v":null}']


def test_manifest_with_stats(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b"), (0, "a")], "o int, k string")
    jsonl.write_with_stats(rows, rows.groupBy().count(), str(tmp_path / "specs"), "o")
    assert [r.value for r in spark.read.text(str(tmp_path / "specs")).collect()] == ['{"k":"a"}', '{"k":"b"}']
    assert spark.read.json(str(tmp_path / "specs.stats")).first()[0] == 2


def test_audit_csv(spark, tmp_path):
    path = tmp_path / "audit.csv"
    path.write_text('video_id,ext,size,last_modified_utc,key\na,.mp4,1,x,y\nb,,1,x,y\nc,"",1,x,y\n')
    assert {r.video: r.ext for r in tables.audit(spark, str(path)).collect()} == {"a": ".mp4", "b": "", "c": ""}


def test_storage(tmp_path, monkeypatch):
    store = storage.storage("local", str(tmp_path))
    assert store.write("a/b.bin", b"1") == str(tmp_path / "a/b.bin") and store.exists("a/b.bin") and not store.exists("a/c.bin")
    monkeypatch.setattr(storage.os, "replace", lambda *a: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        store.write("a/d.bin", b"2")
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["b.bin"]
    other = storage.storage("arrow", f"file://{tmp_path}/arrow")
    other.write("x/y.bin", b"3")
    assert other.exists("x/y.bin") and not other.exists("x/z.bin")
    with pytest.raises(ValueError):
        storage.storage("tape", "x")


def test_only_passing_failures_are_tried_again():
    turns = []

    def fail(error):
        def action():
            turns.append(1)
            raise error

        return action

    for error, tries in ((OSError("HTTP status 503"), 3), (OSError("connection reset"), 3), (PermissionError("no"), 1), (OSError("AWS Error ACCESS_DENIED: Access Denied"), 3), (OSError("got HTTP response 403 Forbidden"), 1), (OSError(28, "no space"), 1)):
        turns.clear()
        with pytest.raises(OSError):
            storage.retried(fail(error), 3, 0.0)
        assert len(turns) == (1 if "enied" in str(error) else tries)


def test_lines_that_are_no_objects_are_named(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"k": 1}\n\n{"x": 2}\n')
    assert sorted(str(r.k) for r in jsonl.read_objects(spark, str(path), "k int").collect()) == ["1", "None"]
    path.write_text('{"k": 1}\n\n[2]\n')
    with pytest.raises(Exception, match="a.jsonl:3: not a JSON object"):
        jsonl.read_objects(spark, str(path), "k int").collect()


# ---- subjects ----


def encoded(array):
    return models.RawCodec().encode(array)


class Square(models.RectangleSegmenter):
    def __init__(self):
        super().__init__([10, 10, 30, 30])


class TwoBoxes(models.ListDetector):
    def __init__(self):
        super().__init__([([9.0, 9.0, 31.0, 31.0], 0.9), ([12.0, 12.0, 14.0, 14.0], 0.8)])


def sample_rows(spark):
    frames = np.full((3, 48, 64, 3), 90, np.uint8)
    scale = 768 / 64
    own = [12 * scale, 12 * scale, 28 * scale, 28 * scale]
    subject = lambda k, box, ref: (k, "a dog in a hat", "a dog", 7, box, encoded(frames[0]) if ref else b"broken", own)
    rows = [("s1", encoded(frames), [subject(1, own, True), subject(2, [700.0, 500.0, 760.0, 560.0], True), subject(3, own, False), subject(4, own, True)]), ("s2", b"no clip", [subject(1, own, True)]), ("s3", encoded(frames[:0]), [])]
    kind = "sample_id string, clip binary, subjects array<struct<subject_id: int, phrase: string, query: string, seed_frame_index: int, seed_box: array<double>, reference: binary, ref_box: array<double>>>"
    return spark.createDataFrame(rows, kind)


def test_report_rows_by_tightening(spark):
    got = subjects.report_rows(sample_rows(spark), models.RawCodec, Square, models.MeanEmbedder).collect()
    built = {r.subject_id: r for r in got if r.status == "built"}
    assert sorted(built) == [1, 2] and sorted(r.sample_id for r in got if r.status == "failed") == ["s1", "s2", "s3"]
    one = built[1]
    assert (one.box_ref, one.box_seed, one.pick_ref, one.both_tightened, one.identity, one.stop_ref) == ([10, 10, 30, 30], [10, 10, 30, 30], "dis", True, 1.0, "settled")
    assert (built[2].box_seed, built[2].pick_seed, built[2].both_tightened, built[2].identity, built[2].stop_seed) == (None, "no_box", False, None, "empty")


def test_report_rows_by_pairs(spark):
    rows = subjects.report_rows(sample_rows(spark), models.RawCodec, Square, models.MeanEmbedder, TwoBoxes)
    got = {r.subject_id: r for r in rows.collect() if r.status == "built"}
    # the annotated box sees 16 x 16 pixels, the detector's the whole square; the part box is left out
    assert (got[1].ref_candidates, got[1].seed_candidates, got[1].pairs_scored, got[1].identity, got[1].margin) == (2, 2, 4, 1.0, 0.0)
    assert got[1].box_ref == [12, 12, 28, 28] and not got[1].used_detector
    assert got[2].used_detector and got[2].box_seed == [10, 10, 30, 30]
    count = subjects.counts(rows).first()
    assert count[:] == (2, 2, 3, 1, False)
    assert subjects.counts(rows.where("status = 'failed'")).first().aborted and not subjects.counts(rows.where("false")).first().aborted
    assert subjects.timing(rows, 3.14159).first()[:2] == (3.14, 1.571)


def test_crops_and_outlines():
    frame = np.arange(6 * 5 * 3, dtype=np.uint8).reshape(6, 5, 3)
    assert raster.crop_box(frame, [1.4, 1.6, 1.5, 99]).shape == (4, 1, 3) and raster.crop_box(frame, None) is None and raster.crop_box(frame, [1, 2, None, 4]) is None
    mask = np.zeros((9, 9), bool)
    mask[1:8, 1:8] = True
    assert raster.thick_outline(mask).sum() == 49 - 9 and not raster.thick_outline(np.zeros((3, 3), bool)).any()


def test_box_documents_and_mask_files(spark):
    masks = np.zeros((2, 3, 10), bool)
    masks[0, 1, 4] = True
    rows = [("a", 2, "passed", None, [1, 0], [[4, 1, 5, 2], None], raster.pack(masks).tobytes(), 10, 2), ("a", 1, "passed", None, [0, 0], [None, None], raster.pack(masks * False).tobytes(), 10, 2), ("a", 3, "dropped", "empty_masklet", None, None, None, 10, 2), ("b", 1, "dropped", "empty_ref_mask", None, None, None, 10, 2)]
    frame = spark.createDataFrame(rows, "sample_id string, subject_id int, status string, reason string, areas array<long>, boxes array<array<int>>, packed binary, width int, frame_count int")
    document = manifests.box_documents(frame).collect()
    assert [r.path for r in document] == ["bbox/a.json"]
    told = json.loads(document[0].text)
    assert [o["subject_id"] for o in told["objects"]] == [1, 2] and told["objects"][1]["bboxes_xyxy"][0] == [4, 1, 5, 2] and told["dropped_subjects"] == [{"subject_id": 3, "reason": "empty_masklet"}]
    (one,) = manifests.mask_files(frame).collect()
    data = np.load(io.BytesIO(one.data))
    assert one.path == "masklets/a.npz" and data["source_subject_ids"].tolist() == [1, 2] and int(data["mask_width"]) == 10 and int(data["mask_format_version"]) == 2
    assert (raster.unpack(data["subject_masks_packed"], 10)[1] == masks).all()


# ---- streaming ----


def test_incremental_run_resumes(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"sample_id": "a", "n": 1}\n{"sample_id": "b", "n": 2}\n')
    manifest, checkpoint = str(tmp_path / "manifest"), str(tmp_path / "checkpoint")

    def stage(rows):
        return rows.withColumn("status", F.when(F.col("n") == 2, "failed").otherwise("passed"))

    run = lambda: incremental.run_once(spark, str(source), "sample_id string, n int", stage, manifest, checkpoint)
    run()
    assert {r.sample_id: r.status for r in incremental.latest(spark, manifest).collect()} == {"a": "passed", "b": "failed"}
    run()
    (source / "2.json").write_text('{"sample_id": "a", "n": 2}\n{"sample_id": "b", "n": 3}\n{"sample_id": "c", "n": 4}\n')
    run()
    assert {r.sample_id: (r.status, r.n) for r in incremental.latest(spark, manifest).collect()} == {"a": ("passed", 1), "b": ("passed", 3), "c": ("passed", 4)}
