"""Queries over candidate pools, best pairs and the gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import geometry as g
from framewright.operators import gate, pool, subjects
from framewright.plans import derived as d
from framewright.plans.boxes import _IOU, _round
from framewright.plans.registry import query

LEAST = 0.2

_COS = (
    "list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), lambda x, y: x + y)",
    "sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(a.v, lambda p: p * p)), lambda x, y: x + y))",
    "sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(b.v, lambda p: p * p)), lambda x, y: x + y))",
)
_PAIRS = (
    "vectors AS (SELECT pool, side, place, origin, CAST(embedding AS DOUBLE[]) AS v FROM pools),"
    f" pairs AS (SELECT a.pool, a.place AS ref_index, b.place AS seed_index, a.origin AS ref_origin, b.origin AS seed_origin, {_round(f'{_COS[0]} / ({_COS[1]} * {_COS[2]})', 6)} AS similarity"
    " FROM vectors a JOIN vectors b ON a.pool = b.pool AND a.side = 0 AND b.side = 1)"
)


def _sides(spark, sf_dir):
    return d.pools(spark, sf_dir, 0), d.pools(spark, sf_dir, 1)


@query("SELECT pool, ref_index, seed_index, similarity FROM pairs", d.POOLS, _PAIRS)
def scored_pairs(spark, sf_dir):
    return pool.scored_pairs(*_sides(spark, sf_dir), ["pool"]).select("pool", "ref_index", "seed_index", "similarity")


_BEST = (
    "ranked AS (SELECT *, row_number() OVER w AS n, lead(similarity) OVER w AS next, count(*) OVER (PARTITION BY pool) AS pairs_scored FROM pairs WINDOW w AS (PARTITION BY pool ORDER BY similarity DESC, ref_index, seed_index)),"
    " counts AS (SELECT pool, count(*) FILTER (side = 0) AS ref_candidates, count(*) FILTER (side = 1) AS seed_candidates FROM pools GROUP BY pool)"
)


@query(
    f"SELECT c.pool, ref_index, seed_index, similarity AS identity, {_round('similarity - next', 6)} AS margin, coalesce(pairs_scored, 0) AS pairs_scored, ref_candidates, seed_candidates,"
    " coalesce(ref_origin = 'detector' OR seed_origin = 'detector', false) AS used_detector FROM counts c LEFT JOIN ranked r ON r.pool = c.pool AND r.n = 1",
    d.POOLS, _PAIRS, _BEST,
)
def best_pair(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return pool.best_pair(pool.scored_pairs(left, right, ["pool"]), left, right, ["pool"])


@query(f"SELECT pool, {_round('similarity - next', 6)} AS margin FROM ranked WHERE n = 1 AND similarity - next < 0.02", d.POOLS, _PAIRS, _BEST)
def pair_margin(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return pool.best_pair(pool.scored_pairs(left, right, ["pool"]), left, right, ["pool"]).where("margin < 0.02").select("pool", "margin")


@query("SELECT event_id, user_id, CAST(rank AS INTEGER) AS rank FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) - 1 AS rank FROM events WHERE value >= 0.25) WHERE rank < 6")
def topk_scores(spark, sf_dir):
    rows = d.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return pool.top_scores(rows, ["user_id"], "event_id", "value").select("event_id", "user_id", "rank")


# Four successive lines of an order are a pool: the first is annotated, the others are detected.
_LINES = (
    "lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, x1, y1, x2) - 1 AS k0 FROM boxes),"
    " found AS (SELECT * EXCLUDE (l_orderkey), l_orderkey * 1000 + k0 // 4 AS pool, k0 % 4 AS k FROM lines)"
)
_MEMBERS = (
    "members AS (SELECT f.pool, f.k AS place, CASE WHEN f.k = 0 THEN 'annotation' ELSE 'detector' END AS origin, f.x1, f.y1, f.x2, f.y2 FROM found f JOIN found a ON a.pool = f.pool AND a.k = 0"
    " WHERE f.k = 0 OR (greatest(0.0, f.x2 - f.x1) * greatest(0.0, f.y2 - f.y1) >= greatest(1.0, (a.x2 - a.x1) * (a.y2 - a.y1)) * 0.3))"
)


def _lines(spark, sf_dir):
    from pyspark.sql.window import Window

    rows = d.boxes(spark, sf_dir)
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "x1", "y1", "x2")
    rows = rows.withColumn("at", F.row_number().over(order) - 1)
    return rows.select((F.col("l_orderkey") * 1000 + F.floor(F.col("at") / 4)).alias("pool"), (F.col("at") % 4).alias("k"), g.Box.of().array().alias("box"))


def _members(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    annotated = rows.where("k = 0").select("pool", "box")
    detected = rows.where("k > 0").select("pool", (F.col("k") - 1).alias("rank"), "box", F.lit(0.5).alias("score"))
    return pool.pool(annotated, detected, ["pool"])


@query("SELECT pool, CAST(place AS INTEGER) AS place, origin, x1, y2 FROM members", d.BOXES, _LINES, _MEMBERS)
def candidate_pool(spark, sf_dir):
    return _members(spark, sf_dir).select("pool", "place", "origin", F.get("box", F.lit(0)).alias("x1"), F.get("box", F.lit(3)).alias("y2"))


_SAME = f"same AS (SELECT a.pool, a.place AS p, b.place AS q, coalesce({_IOU} >= 0.9, false) AS dup FROM members a JOIN members b ON a.pool = b.pool AND a.place < b.place)"
# Pools have four members at most, so keeping is unrolled: a member stays unless an earlier one that stayed repeats it.
_KEPT = (
    "k0 AS (SELECT pool, place FROM members WHERE place = 0),"
    " k1 AS (SELECT * FROM k0 UNION ALL SELECT m.pool, m.place FROM members m WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM same s JOIN k0 k ON k.pool = s.pool AND k.place = s.p WHERE s.pool = m.pool AND s.q = m.place AND s.dup)),"
    " k2 AS (SELECT * FROM k1 UNION ALL SELECT m.pool, m.place FROM members m WHERE place = 2 AND NOT EXISTS (SELECT 1 FROM same s JOIN k1 k ON k.pool = s.pool AND k.place = s.p WHERE s.pool = m.pool AND s.q = m.place AND s.dup)),"
    " k3 AS (SELECT * FROM k2 UNION ALL SELECT m.pool, m.place FROM members m WHERE place = 3 AND NOT EXISTS (SELECT 1 FROM same s JOIN k2 k ON k.pool = s.pool AND k.place = s.p WHERE s.pool = m.pool AND s.q = m.place AND s.dup)),"
    " gone AS (SELECT m.pool, m.place, min(s.p) AS by FROM members m JOIN same s ON s.pool = m.pool AND s.q = m.place AND s.dup JOIN k3 k ON k.pool = s.pool AND k.place = s.p"
    " WHERE NOT EXISTS (SELECT 1 FROM k3 x WHERE x.pool = m.pool AND x.place = m.place) GROUP BY m.pool, m.place)"
)


@query(
    "SELECT k.pool, CAST(k.place AS INTEGER) AS place, (SELECT count(*) FROM gone g WHERE g.pool = k.pool AND g.by = k.place) AS also FROM k3 k",
    d.BOXES, _LINES, _MEMBERS, _SAME, _KEPT,
)
def greedy_dedupe(spark, sf_dir):
    out = pool.deduped(_members(spark, sf_dir), ["pool"], ["place"])
    return out.select("pool", "place", F.size("also").cast("long").alias("also"))


# ---- gate ----

_D = (
    "ruled AS (SELECT *, pick_ref = 'no_box' OR pick_seed = 'no_box' AS boxless, coalesce(identity >= 0.2, false) AS ok FROM records),"
    " verdicts AS (SELECT *, CASE WHEN boxless OR NOT ok THEN 'drop' ELSE 'keep' END AS verdict, CASE WHEN boxless THEN 'no_box' WHEN NOT ok THEN 'identity' END AS why,"
    " CASE WHEN boxless THEN 'no usable box on the ' || CASE WHEN pick_ref = 'no_box' AND pick_seed = 'no_box' THEN 'ref and seed' WHEN pick_ref = 'no_box' THEN 'ref' ELSE 'seed' END || ' side' WHEN identity IS NULL THEN 'no identity score'"
    " ELSE 'identity ' || printf('%.3f', identity) || CASE WHEN ok THEN ' >= 0.2' ELSE ' < 0.2' END END AS told FROM ruled)"
)


@query("SELECT subject_id, verdict, why AS gate, told AS reason, ok AS identity_ok FROM verdicts", d.RECORDS, _D)
def gate_decide(spark, sf_dir):
    ruling = gate.decide(F.col("identity"), F.col("pick_ref"), F.col("pick_seed"), LEAST)
    return d.records(spark, sf_dir).select("subject_id", ruling.alias("d")).select("subject_id", "d.verdict", "d.gate", "d.reason", "d.identity_ok")


def _gated_sql(keep_all: str) -> str:
    return (
        f"gated AS (SELECT s.sample_id, s.subject_id, r.identity, r.box_ref, r.box_seed, coalesce(r.verdict = 'keep' AND r.box_ref IS NOT NULL AND r.box_seed IS NOT NULL, false) OR ({keep_all} AND r.verdict = 'drop' AND r.box_ref IS NOT NULL AND r.box_seed IS NOT NULL) AS out,"
        " CASE WHEN r.subject_id IS NULL THEN 'no_record' WHEN r.verdict = 'drop' THEN r.why WHEN r.box_ref IS NULL OR r.box_seed IS NULL THEN 'no_box' END AS gate,"
        f" coalesce({keep_all} AND r.verdict = 'drop' AND r.box_ref IS NOT NULL AND r.box_seed IS NOT NULL, false) AS kept_anyway"
        " FROM subjects s LEFT JOIN verdicts r ON r.sample_id = s.sample_id AND r.subject_id = s.subject_id)"
    )


def _gated(spark, sf_dir, keep_all=False):
    return gate.gate(d.subjects(spark, sf_dir), d.records(spark, sf_dir), LEAST, "row_idx", keep_all)


@query("SELECT sample_id, subject_id, box_ref AS ref_box, box_seed AS seed_box, 'frame' AS box_space FROM gated WHERE out", d.SUBJECTS, d.RECORDS, _D, _gated_sql("false"))
def gate_apply(spark, sf_dir):
    return gate.corrected(_gated(spark, sf_dir)).select("sample_id", "subject_id", "ref_box", "seed_box", "box_space")


@query("SELECT sample_id, subject_id, gate, identity, kept_anyway FROM gated WHERE gate IS NOT NULL", d.SUBJECTS, d.RECORDS, _D, _gated_sql("false"))
def gate_drops(spark, sf_dir):
    return gate.drops(_gated(spark, sf_dir)).drop("reason")


@query("SELECT sample_id, subject_id, gate, kept_anyway FROM gated WHERE out", d.SUBJECTS, d.RECORDS, _D, _gated_sql("true"))
def gate_keep_all(spark, sf_dir):
    return gate.corrected(_gated(spark, sf_dir, True)).select("sample_id", "subject_id", "gate", "kept_anyway")


@query(
    "SELECT count(*) AS samples_in, CAST(sum(CAST(k > 0 AS INTEGER)) AS BIGINT) AS samples_out, CAST(sum(CAST(k = 0 AS INTEGER)) AS BIGINT) AS samples_emptied, CAST(sum(n) AS BIGINT) AS subjects_in, CAST(sum(k) AS BIGINT) AS subjects_out, CAST(sum(a) AS BIGINT) AS subjects_dropped, CAST(sum(w) AS BIGINT) AS subjects_kept_anyway, CAST(sum(g1) AS BIGINT) AS no_record, CAST(sum(g2) AS BIGINT) AS no_box, CAST(sum(g3) AS BIGINT) AS identity"
    " FROM (SELECT sample_id, count(*) AS n, sum(CAST(out AS INTEGER)) AS k, count(gate) AS a, sum(CAST(kept_anyway AS INTEGER)) AS w, count(*) FILTER (gate = 'no_record') AS g1, count(*) FILTER (gate = 'no_box') AS g2, count(*) FILTER (gate = 'identity') AS g3 FROM gated GROUP BY sample_id)",
    d.SUBJECTS, d.RECORDS, _D, _gated_sql("true"),
)
def gate_funnel(spark, sf_dir):
    return gate.funnel(_gated(spark, sf_dir, True))


# ---- report ----

_REPORT = "CASE WHEN o_orderkey % 10 = 3 THEN 'failed' ELSE 'built' END AS status, CASE WHEN o_orderkey % 10 <> 3 THEN o_orderkey % 7 <> 0 END AS both_tightened, CASE WHEN o_orderkey % 10 <> 3 THEN o_orderkey % 3 = 0 END AS used_detector"


@query(
    "SELECT count(*) FILTER (status = 'built') AS subjects, count(*) FILTER (status = 'built' AND both_tightened) AS both_tightened, count(*) FILTER (status = 'failed') AS failures, count(*) FILTER (status = 'built' AND used_detector) AS detector_won,"
    f" count(*) FILTER (status = 'built') = 0 AND count(*) FILTER (status = 'failed') >= 3 AS aborted FROM (SELECT {_REPORT} FROM orders)"
)
def report_counts(spark, sf_dir):
    return subjects.counts(d.table(spark, sf_dir, "orders").selectExpr(*_REPORT.split(", ")))
