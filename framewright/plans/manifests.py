"""Queries over manifests, paths, rasters and round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framewright.functions.geometry import Box, clamp_box
from framewright.operators import manifests, raster, select
from framewright.operators.models import RectangleSegmenter
from framewright.plans import derived as d
from framewright.plans.boxes import _clamp, _clamped, _round
from framewright.plans.registry import joined, query
from framewright.sources import jsonl
from framewright.sources.shared import shared_dir

_OLD = "SELECT o_orderkey AS sample_id, o_totalprice AS size, 'old' AS made, o_orderkey AS pos FROM orders WHERE o_orderkey % 2 = 0"
_PART = "SELECT o_orderkey AS sample_id, o_totalprice + 1 AS size, 'partial' AS made, o_orderkey AS pos FROM orders WHERE o_orderkey % 3 = 0"
_NEW = "SELECT o_orderkey AS sample_id, o_totalprice + 2 AS size, 'new' AS made, o_orderkey AS pos FROM orders WHERE o_orderkey % 5 = 0"


def _layer(spark, sf_dir, by, made, more):
    rows = d.table(spark, sf_dir, "orders").where(f"o_orderkey % {by} = 0")
    return rows.select(F.col("o_orderkey").alias("sample_id"), (F.col("o_totalprice") + more).alias("size"), F.lit(made).alias("made"), F.col("o_orderkey").alias("pos"))


@query(
    f"SELECT sample_id, size, made, position FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY rank DESC) AS n FROM (SELECT *, 0 AS rank FROM ({_OLD}) UNION ALL SELECT *, 1 FROM ({_PART}) UNION ALL SELECT *, 2 FROM ({_NEW})))"
    " LEFT JOIN (SELECT o_orderkey AS sample_id, o_custkey AS position FROM orders WHERE o_orderkey % 4 <> 0) USING (sample_id) WHERE n = 1"
)
def manifest_upsert(spark, sf_dir):
    merged = select.upsert("sample_id", "pos", *(_layer(spark, sf_dir, *x) for x in ((2, "old", 0.0), (3, "partial", 1.0), (5, "new", 2.0))))
    specs = d.table(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("at"))
    return select.manifest_order(merged, specs, "sample_id", "at").select("sample_id", "size", "made", "position")


_STATUS = "CASE o_orderkey % 4 WHEN 0 THEN 'passed' WHEN 1 THEN 'failed' WHEN 2 THEN 'rejected' END"


@query(f"SELECT o_orderkey AS sample_id, o_custkey FROM orders WHERE coalesce({_STATUS}, 'none') NOT IN ('passed', 'rejected')")
def resume_pending(spark, sf_dir):
    rows = d.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"), "o_custkey")
    markers = d.table(spark, sf_dir, "orders").selectExpr("o_orderkey as sample_id", f"{_STATUS} as status").where("status is not null")
    return select.pending(rows, markers, "sample_id")


@query(
    "SELECT count(*) AS rows, CAST(sum(size) AS BIGINT) AS bytes_total, CAST(floor(sum(size) / count(size)) AS BIGINT) AS bytes_mean, count(*) FILTER (flagged) AS flagged, list_sort(list(size))[CAST(floor(count(size) / 2) AS BIGINT) + 1] AS bytes_median,"
    " (SELECT string_agg(sample_id, ',' ORDER BY sample_id) FROM (SELECT 'k' || o_orderkey AS sample_id FROM orders WHERE o_orderkey % 37 = 0 ORDER BY 1 LIMIT 50)) AS flagged_samples FROM (SELECT CAST(o_totalprice AS BIGINT) AS size, o_orderkey % 37 = 0 AS flagged FROM (SELECT floor(o_totalprice) AS o_totalprice, o_orderkey FROM orders))"
)
def extract_summary(spark, sf_dir):
    rows = d.table(spark, sf_dir, "orders").select(F.floor("o_totalprice").alias("size"), (F.col("o_orderkey") % 37 == 0).alias("flagged"), F.expr("'k' || o_orderkey").alias("sample_id"))
    return manifests.size_summary(rows, "size").withColumn("flagged_samples", joined(F.col("flagged_samples")))


@query("SELECT w || 'x' || h AS resolution, count(*) AS n FROM sizes GROUP BY 1", d.SIZES)
def resolution_counts(spark, sf_dir):
    return manifests.resolutions(d.sizes(spark, sf_dir), "w", "h")


_PATH = "CASE page_id % 4 WHEN 0 THEN 'clips/' || sha256(url) || '.mp4' WHEN 1 THEN 'extracted' || page_id || '.jsonl' WHEN 2 THEN 'manifests/a' || page_id || '.json' ELSE 'ref_frames/x/' || page_id || '_subj01.jpg' END"


def _paths(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").selectExpr("page_id", f"{_PATH.replace('sha256(url)', 'sha2(url, 256)')} as path")


@query(
    "SELECT page_id, 'data/' || CASE WHEN len(p) = 1 THEN 'manifests/' || path WHEN p[1] = 'manifests' THEN path ELSE array_to_string(list_slice(p, 1, len(p) - 1), '/') || '/' || substr(p[len(p)], 1, 2) || '/' || p[len(p)] END AS key"
    f" FROM (SELECT page_id, path, string_split(path, '/') AS p FROM (SELECT page_id, {_PATH} AS path FROM pages))"
)
def storage_key(spark, sf_dir):
    return _paths(spark, sf_dir).select("page_id", manifests.storage_key(manifests.safe_path(F.col("path")), "data").alias("key"))


_RISKY = "CASE page_id % 6 WHEN 0 THEN 'a/b' || page_id WHEN 1 THEN '../x' WHEN 2 THEN '/abs' || page_id WHEN 3 THEN '' WHEN 4 THEN 'clips/' ELSE 'a..b/c' END"


@query(f"SELECT page_id, path <> '' AND path NOT LIKE '%/' AND path NOT LIKE '/%' AND NOT list_contains(string_split(path, '/'), '..') AS safe FROM (SELECT page_id, {_RISKY} AS path FROM pages)")
def path_guard(spark, sf_dir):
    return d.table(spark, sf_dir, "pages").selectExpr("page_id", f"{_RISKY} as path").select("page_id", manifests.is_safe_path(F.col("path")).alias("safe"))


@query("SELECT o_orderkey, 'clips/s' || o_orderkey || '.mp4' AS clip, 'ref_frames/s' || o_orderkey || '_subj' || printf('%02d', o_custkey % 130) || '.jpg' AS ref FROM orders")
def artifact_paths(spark, sf_dir):
    s = F.expr("'s' || o_orderkey")
    return d.table(spark, sf_dir, "orders").select("o_orderkey", manifests.clip_path(s).alias("clip"), manifests.reference_path(s, F.col("o_custkey") % 130).alias("ref"))


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN role WHEN turn % 3 = 1 THEN text ELSE 'none' END AS prompt, CASE WHEN conv_id % 2 = 0 THEN 'frame' ELSE 'annotation' END AS box_space FROM conversations")
def parse_contract(spark, sf_dir):
    rows = d.table(spark, sf_dir, "conversations")
    phrase, prompt = F.when(F.col("turn") % 3 == 0, F.col("role")), F.when(F.col("turn") % 3 == 1, F.col("text"))
    space = F.when(F.col("conv_id") % 2 == 0, "frame").when(F.col("conv_id") % 4 == 1, "")
    return rows.select("conv_id", "turn", manifests.required("subject", phrase, prompt, F.lit("none")).alias("prompt"), manifests.box_space(space).alias("box_space"))


def _scratch(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def jsonl_roundtrip(spark, sf_dir):
    path = _scratch(spark, "jsonl")
    rows = d.table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    jsonl.write(rows, path)
    return jsonl.read(spark, path, rows.schema, "c_custkey")


@query("SELECT c_custkey, c_name FROM customer")
def jsonl_strict(spark, sf_dir):
    path = _scratch(spark, "lines")
    rows = d.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rows.select(F.explode(F.array(F.to_json(F.struct("c_custkey", "c_name")), F.lit(""))).alias("value")).write.text(path)
    return jsonl.read(spark, path, "c_custkey long, c_name string")


# ---- rasters: the boxes of every order, drawn into a mask of 54 x 30 ----

_DRAWN = f"drawn AS (SELECT l_orderkey, {_clamp('x1 / 16', 'y1 / 16', 'x2 / 16', 'y2 / 16', '54', '30')} FROM boxes)"
# Components of a union of boxes are those of the graph of boxes that overlap or share a side; pixels are counted on lines of bits.
_COMPONENTS = (
    "box AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY x1, y1, x2, y2) AS i FROM (SELECT DISTINCT * FROM drawn)),"
    " touch AS MATERIALIZED (SELECT a.l_orderkey, a.i, b.i AS j FROM box a JOIN box b ON a.l_orderkey = b.l_orderkey AND ((a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2) OR (a.y1 < b.y2 AND b.y1 < a.y2 AND a.x1 <= b.x2 AND b.x1 <= a.x2))),"
    " reach AS (SELECT l_orderkey, i, j FROM touch UNION SELECT r.l_orderkey, r.i, t.j FROM reach r JOIN touch t ON t.l_orderkey = r.l_orderkey AND t.i = r.j),"
    " own AS (SELECT l_orderkey, i, min(j) AS part FROM reach GROUP BY l_orderkey, i),"
    " line AS (SELECT l_orderkey, part, y, bit_or(bits) AS bits FROM (SELECT o.l_orderkey, o.part, unnest(range(b.y1, b.y2)) AS y, ((CAST(1 AS BIGINT) << (b.x2 - b.x1)) - 1) << (56 - b.x2) AS bits FROM box b JOIN own o ON o.l_orderkey = b.l_orderkey AND o.i = b.i) GROUP BY ALL),"
    " part AS (SELECT l_orderkey, part, CAST(sum(bit_count(bits)) AS BIGINT) AS n FROM line GROUP BY l_orderkey, part),"
    " judged AS (SELECT *, count(*) OVER w AS parts, max(n) OVER w AS most, sum(n) OVER w AS total FROM part WINDOW w AS (PARTITION BY l_orderkey)),"
    " kept AS (SELECT l_orderkey, part FROM judged WHERE parts = 1 OR n >= greatest(most * CAST(0.05 AS DOUBLE), 16)),"
    " clean AS (SELECT l.l_orderkey, l.y, bit_or(l.bits) AS bits FROM line l JOIN kept k ON k.l_orderkey = l.l_orderkey AND k.part = l.part GROUP BY l.l_orderkey, l.y)"
)


def _drawn(rows):
    box = Box.of().each(lambda c: c / 16)
    return rows.select("l_orderkey", *clamp_box(box, F.lit(54), F.lit(30)).columns())


def _masks(boxes):
    """key, h, w, packed: all boxes of an order in one mask of 54 x 30. A box is one run of bits in each of its lines, and lines are or-ed before the shuffle."""
    lines = _drawn(boxes).select("l_orderkey", F.expr("shiftleft(shiftleft(1L, x2 - x1) - 1L, 56 - x2)").alias("bits"), F.explode(F.sequence("y1", F.col("y2") - 1)).alias("y"))
    lines = lines.groupBy("l_orderkey", "y").agg(F.lpad(F.hex(F.bit_or("bits")), 14, "0").alias("line"))
    rows = lines.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("y", "line"))).alias("m"))
    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(29)), lambda y: F.coalesce(F.try_element_at("m", y), F.lit("0" * 14))), "")
    return rows.select(F.col("l_orderkey").alias("key"), F.lit(30).alias("h"), F.lit(54).alias("w"), F.unhex(whole).alias("packed"))


@query("SELECT l_orderkey, array_to_string([min(x1), min(y1), max(x2), max(y2)], ',') AS box FROM drawn GROUP BY l_orderkey", d.BOXES, _DRAWN)
def mask_bbox(spark, sf_dir):
    # the box of a union needs no pixels
    found = _drawn(d.boxes(spark, sf_dir)).groupBy("l_orderkey").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    return found.select("l_orderkey", joined(Box.of().array()).alias("box"))


@query(
    f"SELECT j.l_orderkey, CAST(any_value(parts) AS INTEGER) AS components, {_round('any_value(most) / CAST(any_value(total) AS DOUBLE)', 6)} AS largest_share, CAST(coalesce(sum(j.n) FILTER (k.part IS NOT NULL), 0) AS BIGINT) AS pixels"
    " FROM judged j LEFT JOIN kept k ON k.l_orderkey = j.l_orderkey AND k.part = j.part GROUP BY j.l_orderkey",
    d.BOXES, _DRAWN, _COMPONENTS, recursive=True,
)
def mask_components(spark, sf_dir):
    return raster.measured(_masks(d.boxes(spark, sf_dir))).select(F.col("key").alias("l_orderkey"), "components", "largest_share", "pixels")


@query(
    "SELECT l_orderkey, CAST(210 AS INTEGER) AS n_bytes, sha256(unhex(string_agg(printf('%014x', coalesce(c.bits, 0)), '' ORDER BY y))) AS digest"
    " FROM (SELECT DISTINCT l_orderkey, unnest(range(0, 30)) AS y FROM drawn) s LEFT JOIN clean c USING (l_orderkey, y) GROUP BY l_orderkey",
    d.BOXES, _DRAWN, _COMPONENTS, recursive=True,
)
def mask_pack(spark, sf_dir):
    return raster.measured(_masks(d.boxes(spark, sf_dir))).select(F.col("key").alias("l_orderkey"), F.length("packed").alias("n_bytes"), F.sha2("packed", 256).alias("digest"))


# The thing that the stand-in segmenter sees, in a frame of 214 x 120.
_THING = (40, 20, 150, 100)
_NEXT = "x1 - (x2 - x1) * 0.15::DOUBLE", "y1 - (y2 - y1) * 0.15::DOUBLE", "x2 + (x2 - x1) * 0.15::DOUBLE", "y2 + (y2 - y1) * 0.15::DOUBLE"
_TIGHTENED = (
    f"first AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_partkey, l_suppkey, {_clamp('x1 / 4', 'y1 / 4', 'x2 / 4', 'y2 / 4', '214', '120')} FROM boxes),"
    " turns AS (SELECT rid, 0 AS turn, x1, y1, x2, y2, CASE WHEN least(x2 - x1, y2 - y1) < 2 THEN 'degenerate' END AS stop, 0 AS rounds, CAST(NULL AS INTEGER[]) AS tight FROM first UNION ALL"
    " SELECT rid, turn + 1, g.x1, g.y1, g.x2, g.y2, CASE WHEN nothing THEN CASE WHEN turn = 0 THEN 'empty' ELSE 'emptied' END WHEN NOT pinned THEN 'settled' WHEN turn < 3 AND p = [g.x1, g.y1, g.x2, g.y2] THEN 'edge' WHEN turn = 3 THEN 'limit' END,"
    " CASE WHEN nothing THEN rounds ELSE turn END, CASE WHEN nothing THEN tight ELSE t END FROM"
    f" (SELECT *, t[3] <= t[1] OR t[4] <= t[2] AS nothing, (t[1] - x1 <= 2 AND x1 > 0) OR (t[2] - y1 <= 2 AND y1 > 0) OR (x2 - t[3] <= 2 AND x2 < 214) OR (y2 - t[4] <= 2 AND y2 < 120) AS pinned, struct_pack({{}}) AS g"
    f" FROM (SELECT *, [x1, y1, x2, y2] AS p, [greatest({_THING[0]}, x1), greatest({_THING[1]}, y1), least({_THING[2]}, x2), least({_THING[3]}, y2)] AS t FROM turns WHERE stop IS NULL)))"
).format(", ".join(f"{k} := {v}" for k, v in zip(("x1", "y1", "x2", "y2"), _clamped(*_NEXT, "214", "120"))))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(rounds AS INTEGER) AS rounds, stop, array_to_string(tight, ',') AS tight FROM turns JOIN first USING (rid) WHERE stop IS NOT NULL",
    d.BOXES, _TIGHTENED, recursive=True,
)
def tighten_trace(spark, sf_dir):
    import numpy as np
    import pandas as pd

    def run(batches):
        frame, thing = np.zeros((120, 214, 3), np.uint8), RectangleSegmenter(list(_THING))
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                got = raster.tighten(thing, frame, [r.x1, r.y1, r.x2, r.y2])
                rows.append((*(getattr(r, k) for k in d.KEYS), got["rounds"], got["stop"], got["tight"]))
            yield pd.DataFrame(rows, columns=[*d.KEYS, "rounds", "stop", "tight"])

    rows = d.boxes(spark, sf_dir).select(*d.KEYS, *(b.alias(n) for b, n in zip(Box.of().each(lambda c: c / 4), ("x1", "y1", "x2", "y2"))))
    found = rows.mapInPandas(run, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, rounds int, stop string, tight array<int>")
    return found.withColumn("tight", joined(F.col("tight")))
