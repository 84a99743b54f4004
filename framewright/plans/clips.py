"""Queries over clips: ids, sources, shards, windows, un-nesting, lookups, specs."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import ids
from framewright.functions.text import strip_indices, subject_noun
from framewright.operators import coverage, lookup, planner, select, unnest
from framewright.plans import derived as d
from framewright.plans.registry import joined, query


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def scan_prune(spark, sf_dir):
    return d.table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_quantity")


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return d.table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query(
    r"SELECT o_orderkey, regexp_extract(video_id, '^(.*)_([^_]*)_([^_]*)$', 1) AS source, CAST(regexp_extract(video_id, '^(.*)_([^_]*)_([^_]*)$', 2) AS DOUBLE) AS start,"
    r" CAST(regexp_extract(video_id, '^(.*)_([^_]*)_([^_]*)$', 3) AS DOUBLE) AS \"end\", regexp_replace('x' || o_orderkey, '(_[^_]*){1,2}$', '') AS loose FROM clips".replace('\\"', '"'),
    d.CLIPS,
)
def parse_vid(spark, sf_dir):
    v = F.col("video_id")
    return d.clips(spark, sf_dir).select(
        "o_orderkey", ids.clip_source(v).alias("source"), ids.clip_start(v).alias("start"), ids.clip_end(v).alias("end"), ids.source_of(F.concat(F.lit("x"), "o_orderkey")).alias("loose")
    )


@query("SELECT o_orderkey, 'c' || o_custkey || '_w' || printf('%09d', CAST(round_even((o_totalprice / 1000) * 1000.0, 0) AS BIGINT)) AS sample_id FROM orders")
def sample_id(spark, sf_dir):
    return d.table(spark, sf_dir, "orders").select("o_orderkey", ids.sample_id(F.expr("'c' || o_custkey"), F.col("o_totalprice") / 1000).alias("sample_id"))


@query(
    "SELECT o_orderkey, CAST(o_orderkey % 50 AS DOUBLE) + CAST(CAST((o_orderkey % 101) / 100 AS VARCHAR) AS DOUBLE) * (CAST(o_orderkey % 50 + 4 + o_orderkey % 9 AS DOUBLE) - CAST(o_orderkey % 50 AS DOUBLE)) AS t FROM clips",
    d.CLIPS,
)
def frame_time(spark, sf_dir):
    v = F.col("video_id")
    return d.clips(spark, sf_dir).select("o_orderkey", ids.frame_time(ids.clip_start(v), ids.clip_end(v), ((F.col("o_orderkey") % 101) / 100).cast("string")).alias("t"))


_T = "CAST((o_orderkey % 173) AS DOUBLE) / 32"


@query(f"SELECT o_orderkey, least(greatest(CAST(round_even(({_T} - 0.15625) * 16.0, 0) AS INTEGER), 0), 80) AS i FROM orders")
def seed_index(spark, sf_dir):
    return d.table(spark, sf_dir, "orders").select("o_orderkey", ids.seed_index(F.expr(_T), F.lit(0.15625)).alias("i"))


@query(f"SELECT o_orderkey, array_to_string(list_transform(range(0, 81), lambda k: least(CAST(round_even(({_T} + k / 16.0) * 29.97, 0) AS INTEGER), 200)), ',') AS frames FROM orders")
def frame_indices(spark, sf_dir):
    return d.table(spark, sf_dir, "orders").select("o_orderkey", joined(ids.frame_indices(F.expr(_T), F.lit(29.97), F.lit(201))).alias("frames"))


@query(f"SELECT o_orderkey, least(CAST(round_even({_T} * 25.0, 0) AS INTEGER), 99) AS frame FROM orders")
def frame_nearest(spark, sf_dir):
    return d.table(spark, sf_dir, "orders").select("o_orderkey", ids.nearest_frame(F.expr(_T), F.lit(25.0), F.lit(100)).alias("frame"))


@query(
    "SELECT page_id, nullif(regexp_extract(u, 'v=([^&]+)', 1), '') AS video, 'videos/' || nullif(regexp_extract(u, 'v=([^&]+)', 1), '') || '/' || nullif(regexp_extract(u, 'v=([^&]+)', 1), '') || '.mp4' AS object_key"
    " FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE url || '&v=id' || page_id || '&v=other' END AS u FROM pages)"
)
def url_id(spark, sf_dir):
    url = F.expr("CASE WHEN page_id % 3 = 0 THEN url ELSE url || '&v=id' || page_id || '&v=other' END")
    video = ids.url_video_id(url)
    return d.table(spark, sf_dir, "pages").select("page_id", video.alias("video"), ids.object_key(video, F.lit(".mp4"), lookup.ROOT).alias("object_key"))


_OWN = "own AS (SELECT vid, arg_max(coalesce(regexp_extract(url, 'v=([^&]+)', 1), ''), row_idx) AS own FROM meta GROUP BY vid)"
_SHARED = "shared AS (SELECT regexp_replace(vid, '(_[^_]*){1,2}$', '') AS source, arg_max(regexp_extract(url, 'v=([^&]+)', 1), row_idx) AS shared FROM meta WHERE url IS NOT NULL GROUP BY 1)"


@query("SELECT vid, nullif(own, '') AS own, shared FROM own LEFT JOIN shared ON shared.source = regexp_replace(vid, '(_[^_]*){1,2}$', '')", d.CLIPS, d.META, _OWN, _SHARED)
def lookup_last_wins(spark, sf_dir):
    own, shared = lookup.clip_records(d.meta(spark, sf_dir))
    return own.withColumn("source", ids.source_of(F.col("vid"))).join(shared, "source", "left").select("vid", "own", "shared")


_FOUND = (
    "found AS (SELECT c.*, 'videos/' || coalesce(nullif(o.own, ''), s.shared) || '/' || coalesce(nullif(o.own, ''), s.shared) || a.ext AS object_key FROM {} c"
    " LEFT JOIN own o ON o.vid = c.{} LEFT JOIN shared s ON s.source = regexp_replace(c.{}, '(_[^_]*){{1,2}}$', '') LEFT JOIN audit a ON a.video = coalesce(nullif(o.own, ''), s.shared))"
)


@query("SELECT o_orderkey, object_key FROM found", d.CLIPS, d.META, d.AUDIT, _OWN, _SHARED, _FOUND.format("clips", "video_id", "video_id"))
def lookup_fallback(spark, sf_dir):
    return lookup.with_object_key(d.clips(spark, sf_dir), d.meta(spark, sf_dir), d.audit(spark, sf_dir), "video_id").select("o_orderkey", "object_key")


@query("SELECT o_orderkey, sha256('20260725:' || video_id) AS key FROM clips", d.CLIPS)
def hash_order(spark, sf_dir):
    return d.clips(spark, sf_dir).select("o_orderkey", ids.order_key(F.col("video_id")).alias("key"))


_ONE = (
    "one AS (SELECT *, 'c' || o_custkey AS source, sha256('20260725:c' || o_custkey) AS source_key FROM annotated"
    " QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY sha256('20260725:' || video_id), o_orderkey) = 1)"
)


@query("SELECT source, video_id, o_orderkey, source_key FROM one", d.CLIPS, d.ANNOTATED, _ONE)
def one_per_source(spark, sf_dir):
    return select.one_per_source(d.clips(spark, sf_dir), ties=["o_orderkey"]).select("source", "video_id", "o_orderkey", "source_key")


_SHARD = "CAST(CAST('0x' || substr(sha256('shard:c' || o_custkey), 1, 16) AS UBIGINT) % {} AS INTEGER)"


@query(f"SELECT DISTINCT 'c' || o_custkey AS source, {_SHARD.format(16)} AS shard FROM orders")
def shard_assign(spark, sf_dir):
    rows = d.clips(spark, sf_dir).select(ids.source_of(F.col("video_id")).alias("source")).distinct()
    return rows.select("source", ids.shard_of(F.col("source"), 16).alias("shard"))


@query(f"SELECT source, video_id, o_orderkey FROM one WHERE {_SHARD.format(8)} = 3", d.CLIPS, d.ANNOTATED, _ONE)
def shard_select(spark, sf_dir):
    rows = select.one_per_source(d.clips(spark, sf_dir), ties=["o_orderkey"])
    return select.in_shard(rows, 3, 8).select("source", "video_id", "o_orderkey")


@query(f"SELECT {_SHARD.format(16)} AS shard, count(*) AS sources FROM one GROUP BY 1", d.CLIPS, d.ANNOTATED, _ONE)
def shard_balance(spark, sf_dir):
    rows = select.one_per_source(d.clips(spark, sf_dir), ties=["o_orderkey"])
    return rows.groupBy(ids.shard_of(F.col("source"), 16).alias("shard")).agg(F.count("*").alias("sources"))


_ITEM = (
    "item AS (SELECT o_orderkey, video_id, position, phrase, json_array_length(j, '$.obj_from_tgt_video') AS n_targets,"
    " list_sum(list_transform(CAST(json_extract(j, '$.refer_result') AS JSON[]), lambda g: json_array_length(g))) AS n_refs, j,"
    " json_extract_string(j, '$.obj_from_tgt_video[0].vid') AS target_vid FROM"
    " (SELECT o_orderkey, video_id, unnest(json_keys(cross_pair)) AS phrase, unnest(range(0, len(json_keys(cross_pair)))) AS position, json_extract(cross_pair, '$.' || unnest(json_keys(cross_pair))) AS j FROM {})),"
    " judged AS (SELECT *, CASE WHEN n_targets <> 1 OR n_refs <> 1 THEN 'targets=' || n_targets || ',refs=' || n_refs WHEN target_vid <> video_id THEN 'target_vid_mismatch' END AS malformed FROM item)"
)


@query("SELECT o_orderkey, CAST(position AS INTEGER) AS position, phrase, CAST(n_targets AS INTEGER) AS n_targets, CAST(n_refs AS INTEGER) AS n_refs, malformed FROM judged", d.CLIPS, d.ANNOTATED, _ITEM.format("annotated"))
def json_unnest(spark, sf_dir):
    return unnest.by_phrase(d.annotated(spark, sf_dir)).select("o_orderkey", "position", "phrase", F.size("targets").alias("n_targets"), F.size("refs").alias("n_refs"), "malformed")


@query("SELECT coalesce(malformed, 'usable') AS kind, count(*) AS n FROM judged GROUP BY 1", d.CLIPS, d.ANNOTATED, _ITEM.format("annotated"))
def malformed_split(spark, sf_dir):
    return unnest.by_phrase(d.annotated(spark, sf_dir)).groupBy(F.coalesce("malformed", F.lit("usable")).alias("kind")).agg(F.count("*").alias("n"))


_REFS = (
    "refs AS (SELECT o_orderkey, position, 'reference' AS side, unnest(range(0, len(r))) AS place, unnest(r) AS x FROM"
    " (SELECT *, flatten(list_transform(CAST(json_extract(j, '$.refer_result') AS JSON[]), lambda g: CAST(g AS JSON[]))) AS r FROM judged)),"
    " sides AS (SELECT o_orderkey, position, 'target' AS side, 0 AS place, json_extract(j, '$.obj_from_tgt_video[0]') AS x FROM judged UNION ALL SELECT * FROM refs),"
    " timed AS (SELECT o_orderkey, position, side, place, json_extract_string(x, '$.vid') AS vid, CAST(json_extract_string(x, '$.frame_idx') AS DOUBLE) AS f,"
    " CAST(coalesce(json_extract_string(x, '$.bbox_loc[0][2]'), json_extract_string(x, '$.bbox_loc[2]')) AS DOUBLE) AS x2 FROM sides)"
)


@query(
    "SELECT o_orderkey, CAST(position AS INTEGER) AS position, side, CAST(place AS INTEGER) AS place, vid, x2, object_key,"
    " CAST(regexp_extract(vid, '_([^_]*)_[^_]*$', 1) AS DOUBLE) + f * (CAST(regexp_extract(vid, '_([^_]*)$', 1) AS DOUBLE) - CAST(regexp_extract(vid, '_([^_]*)_[^_]*$', 1) AS DOUBLE)) AS t FROM found",
    d.CLIPS, d.ANNOTATED, d.META, d.AUDIT, _OWN, _SHARED, _ITEM.format("annotated"), _REFS, _FOUND.format("timed", "vid", "vid"),
)
def unnest_all(spark, sf_dir):
    rows = unnest.by_clip(unnest.by_phrase(d.annotated(spark, sf_dir)))
    rows = lookup.with_object_key(rows, d.meta(spark, sf_dir), d.audit(spark, sf_dir), "vid")
    t = ids.frame_time(ids.clip_start(F.col("vid")), ids.clip_end(F.col("vid")), F.col("frame_idx"))
    return rows.select("o_orderkey", "position", "side", "place", "vid", F.get(unnest.box_of(F.col("bbox_loc")), F.lit(2)).alias("x2"), "object_key", t.alias("t"))


def _window_sql(source: str, length: float, keys: str) -> str:
    """Common table expressions from rows (keys, start, end, seeds) to `window` (keys, window_start, covered, dropped)."""
    return (
        f"span AS (SELECT *, s0 AS lo, greatest(e0 - {length}, s0) AS hi FROM {source} WHERE e0 - s0 >= {length} - 1e-9),"
        f" starts AS (SELECT *, unnest(list_distinct(list_concat([lo, hi], list_transform(seeds, lambda t: least(greatest(t, lo), hi)), list_transform(seeds, lambda t: least(greatest(t - {length}, lo), hi))))) AS w FROM span),"
        f" sets AS (SELECT * EXCLUDE (w), list_filter(range(0, len(seeds)), lambda i: seeds[i + 1] >= w - 1e-9 AND seeds[i + 1] <= w + {length} + 1e-9) AS covered FROM starts),"
        f" best AS (SELECT * FROM sets WHERE len(covered) > 0 QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY -len(covered), covered) = 1),"
        " edges AS (SELECT *, list_min(list_transform(covered, lambda i: seeds[i + 1])) AS a, list_max(list_transform(covered, lambda i: seeds[i + 1])) AS b FROM best),"
        f" feasible AS (SELECT *, greatest(lo, b - {length}) AS fl, greatest(least(hi, a), greatest(lo, b - {length})) AS fh FROM edges),"
        f" placed AS (SELECT * EXCLUDE (lo, hi, a, b, fl, fh), least(greatest((a + b) / 2.0 - {length} / 2.0, fl), fh) AS window_start, list_filter(range(0, len(seeds)), lambda i: NOT list_contains(covered, i)) AS dropped FROM feasible)"
    )


_DAY = "spans AS (SELECT user_id, day, CAST(0 AS DOUBLE) AS s0, CAST(86400 AS DOUBLE) AS e0, seeds FROM seeds)"


@query("SELECT user_id, CAST(day AS VARCHAR) AS day, window_start, array_to_string(covered, ',') AS covered, array_to_string(dropped, ',') AS dropped FROM placed", d.SEEDS, _DAY, _window_sql("spans", 21600.0, "user_id, day"))
def max_coverage_window(spark, sf_dir):
    rows = d.seeds(spark, sf_dir).withColumns({"start": F.lit(0.0), "end": F.lit(86400.0)})
    return coverage.with_window(rows, length=21600.0).select("user_id", F.col("day").cast("string").alias("day"), "window_start", joined(F.col("covered")).alias("covered"), joined(F.col("dropped")).alias("dropped"))


_PLAN = (
    _ONE,
    "timed_one AS (SELECT *, CAST(o_orderkey % 50 AS DOUBLE) AS s0, CAST(o_orderkey % 50 + 4 + o_orderkey % 9 AS DOUBLE) AS e0 FROM one)",
    _ITEM.format("(SELECT * FROM timed_one WHERE e0 - s0 >= 5.0625 - 1e-9)"),
    "usable AS (SELECT j.o_orderkey, list(s0 + CAST(json_extract_string(j, '$.obj_from_tgt_video[0].frame_idx') AS DOUBLE) * (e0 - s0) ORDER BY position) AS seeds,"
    " list(phrase ORDER BY position) AS phrases, list(json_extract_string(j, '$.refer_result[0][0].vid') ORDER BY position) AS ref_vids FROM judged j JOIN timed_one USING (o_orderkey) WHERE malformed IS NULL GROUP BY j.o_orderkey)",
    "spans AS (SELECT t.o_orderkey, t.video_id, s0, e0, seeds, phrases, ref_vids FROM timed_one t JOIN usable u USING (o_orderkey))",
    _window_sql("spans", 5.0625, "o_orderkey"),
    "wanted AS (SELECT o_orderkey, video_id AS vid, -1 AS place, NULL AS phrase, NULL AS seed FROM timed_one UNION ALL SELECT o_orderkey, ref_vids[i + 1], i, phrases[i + 1], seeds[i + 1] FROM (SELECT *, unnest(covered) AS i FROM placed))",
    _FOUND.format("wanted", "vid", "vid"),
    "subject AS (SELECT f.o_orderkey, row_number() OVER (PARTITION BY f.o_orderkey ORDER BY place) AS subject_id, phrase, seed, window_start, object_key, vid FROM found f JOIN placed p USING (o_orderkey) WHERE place >= 0 AND f.object_key IS NOT NULL)",
    "outcome AS (SELECT t.o_orderkey, t.source_key, t.source, p.window_start, coalesce(s.n, 0) AS n_subjects, CASE WHEN t.e0 - t.s0 < 5.0625 - 1e-9 THEN 'clip_too_short' WHEN u.o_orderkey IS NULL THEN 'no_usable_subject'"
    " WHEN p.o_orderkey IS NULL THEN 'no_window_covers_any_seed' WHEN f.object_key IS NULL THEN 'bos_unresolved' WHEN s.n IS NULL THEN 'no_subject_with_resolved_ref' END AS reason FROM timed_one t"
    " LEFT JOIN (SELECT o_orderkey FROM usable) u USING (o_orderkey) LEFT JOIN placed p USING (o_orderkey) LEFT JOIN (SELECT * FROM found WHERE place < 0) f USING (o_orderkey)"
    " LEFT JOIN (SELECT o_orderkey, count(*) AS n FROM subject GROUP BY 1) s USING (o_orderkey))",
    "drops AS (SELECT o_orderkey, 'malformed_annotation' AS name FROM judged WHERE malformed IS NOT NULL UNION ALL SELECT o_orderkey, 'seed_outside_window' FROM (SELECT o_orderkey, unnest(dropped) FROM placed)"
    " UNION ALL SELECT o_orderkey, 'ref_bos_unresolved' FROM found WHERE place >= 0 AND object_key IS NULL)",
)
_PLAN_SQL = (d.CLIPS, d.ANNOTATED, d.META, d.AUDIT, _OWN, _SHARED, *_PLAN)


def _outcomes(spark, sf_dir):
    rows = select.one_per_source(d.annotated(spark, sf_dir), ties=["o_orderkey"])
    return planner.outcomes(rows, d.meta(spark, sf_dir), d.audit(spark, sf_dir))


@query("SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM outcome GROUP BY 1", *_PLAN_SQL)
def plan_reasons(spark, sf_dir):
    return _outcomes(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    "SELECT s.o_orderkey, o.source || '_w' || printf('%09d', CAST(round_even(s.window_start * 1000.0, 0) AS BIGINT)) AS sample_id, s.window_start, CAST(s.subject_id AS INTEGER) AS subject_id, s.phrase,"
    " least(greatest(CAST(round_even((s.seed - s.window_start) * 16.0, 0) AS INTEGER), 0), 80) AS seed_frame_index, s.object_key AS ref_key, s.vid AS ref_vid FROM subject s JOIN outcome o USING (o_orderkey) WHERE o.reason IS NULL",
    *_PLAN_SQL,
)
def plan_specs(spark, sf_dir):
    rows = _outcomes(spark, sf_dir).where("reason is null").select("o_orderkey", "sample_id", "window_start", F.explode("subjects").alias("s"))
    return rows.select("o_orderkey", "sample_id", "window_start", "s.subject_id", "s.phrase", "s.seed_frame_index", "s.ref_key", "s.ref_vid")


_FIRST = 200
_PREFIX = f"taken AS (SELECT source_key FROM outcome WHERE reason IS NULL ORDER BY source_key LIMIT {_FIRST}), prefix AS (SELECT * FROM outcome WHERE (SELECT count(*) FROM taken) < {_FIRST} OR source_key <= (SELECT max(source_key) FROM taken))"


@query(
    "SELECT 'rejected' AS kind, reason AS name, count(*) AS n FROM prefix WHERE reason IS NOT NULL GROUP BY reason"
    " UNION ALL SELECT 'total', 'sources_considered', count(*) FROM prefix UNION ALL SELECT 'total', 'samples', count(*) FROM prefix WHERE reason IS NULL"
    " UNION ALL SELECT 'total', 'subjects_total', CAST(coalesce(sum(n_subjects), 0) AS BIGINT) FROM prefix WHERE reason IS NULL"
    " UNION ALL SELECT 'subjects', CAST(n_subjects AS VARCHAR), count(*) FROM prefix WHERE reason IS NULL GROUP BY n_subjects"
    " UNION ALL SELECT 'dropped', name, count(*) FROM drops JOIN prefix USING (o_orderkey) WHERE reason IS NULL GROUP BY name",
    *_PLAN_SQL, _PREFIX,
)
def plan_funnel(spark, sf_dir):
    found = planner.counted(_outcomes(spark, sf_dir), "source_key")
    return planner.funnel(select.considered_prefix(found, F.col("reason").isNull(), "source_key", _FIRST))


@query(f"SELECT source, reason FROM prefix", *_PLAN_SQL, _PREFIX)
def first_n(spark, sf_dir):
    return select.considered_prefix(_outcomes(spark, sf_dir).select("source", "reason", "source_key"), F.col("reason").isNull(), "source_key", _FIRST).select("source", "reason")


_JOINERS = "['with','in','wearing','on','at','holding','and','that','which','having','carrying','next','near','behind','beside']"


@query(
    f"SELECT doc_id, CASE WHEN len(kept) > 0 THEN array_to_string(kept, ' ') ELSE trim(p, ' ' || chr(10)) END AS noun FROM (SELECT doc_id, p, CASE WHEN hit IS NULL OR hit = 0 THEN w ELSE list_slice(w, 1, hit - 1) END AS kept FROM"
    f" (SELECT doc_id, p, w, list_position(list_transform(w, lambda x: list_contains({_JOINERS}, trim(lower(x), '.'))), true) AS hit FROM"
    " (SELECT doc_id, p, list_filter(string_split_regex(replace(p, ',', ' '), '\\s+'), lambda x: x <> '') AS w FROM (SELECT doc_id, coalesce(text, '') AS p FROM documents))))"
)
def subject_noun_query(spark, sf_dir):
    return d.table(spark, sf_dir, "documents").select("doc_id", subject_noun(F.col("text")).alias("noun"))


@query(
    "SELECT o_orderkey, array_to_string(CASE WHEN total <= 8 THEN range(0, total) ELSE list_sort(list_distinct(list_concat(list_transform(range(0, 8), lambda i: CAST(round_even(CAST(i * (total - 1) AS DOUBLE) / 7, 0) AS BIGINT)),"
    " CASE WHEN seed >= 0 AND seed < total THEN [seed] ELSE [] END))) END, ',') AS frames FROM (SELECT o_orderkey, o_orderkey % 97 AS total, CAST(o_custkey % 110 AS BIGINT) - 5 AS seed FROM orders)"
)
def strip_indices_query(spark, sf_dir):
    total, seed = (F.col("o_orderkey") % 97).cast("int"), (F.col("o_custkey") % 110 - 5).cast("int")
    return d.table(spark, sf_dir, "orders").select("o_orderkey", joined(strip_indices(total, seed)).alias("frames"))
