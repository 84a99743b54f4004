"""Inputs derived from the driver's tables, once in DataFrame form and once as SQL common table expressions of the same arithmetic.

Boxes come from lineitem, clips and report records from orders, seeds and tracks from
events, candidate pools from embeddings, frame sizes from part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- clips: a source per customer, lengths from 4 to 12 seconds ----

_CLIP = "'c' || o_custkey || '_' || (o_orderkey % 50) || '_' || (o_orderkey % 50 + 4 + o_orderkey % 9)"
CLIPS = f"clips AS (SELECT o_orderkey, o_custkey, {_CLIP} AS video_id FROM orders)"


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.expr(_CLIP).alias("video_id"))


_ENTRY = (
    "'\"p' || k || '\": {\"obj_from_tgt_video\": [{\"vid\": \"' || CASE WHEN (o_orderkey + k) % 17 = 0 THEN 'other_0_9' ELSE video_id END"
    " || '\", \"frame_idx\": \"0.' || lpad(CAST((o_orderkey * 7 + k * 13) % 100 AS {text}), 2, '0') || '\", \"bbox_loc\": [' || (k * 10) || ', 20, ' || (k * 10 + 100) || ', 200], \"bbox_cls\": \"thing\"}}],"
    " \"refer_result\": [[' || {ref} || ']' || CASE WHEN (o_orderkey + k) % 11 = 0 THEN ', [' || {ref} || ']' ELSE '' END || ']}}'"
)
_REF = "'{\"vid\": \"c' || (o_custkey + k) || '_' || k || '_' || (k + 6) || '\", \"frame_idx\": 0.5, \"bbox_loc\": [[5, 6, ' || (50 + k) || ', 60.5]], \"scores\": 0.9}'"


def _pairs(each: str) -> str:
    return each.replace("{{", "{").replace("}}", "}")


_SPARK_PAIRS = "'{' || array_join(transform(sequence(0, int(o_orderkey % 3)), k -> " + _pairs(_ENTRY.replace("{ref}", _REF).replace("{text}", "string")) + "), ', ') || '}'"
_SQL_PAIRS = "'{' || array_to_string(list_transform(range(0, o_orderkey % 3 + 1), lambda k: " + _pairs(_ENTRY.replace("{ref}", _REF).replace("{text}", "VARCHAR")) + "), ', ') || '}'"
ANNOTATED = f"annotated AS (SELECT *, {_SQL_PAIRS} AS cross_pair FROM clips)"


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clips with annotation text: one to three phrases, some malformed."""
    return clips(spark, sf_dir).withColumn("cross_pair", F.expr(_SPARK_PAIRS))


_URL = "CASE WHEN o_orderkey % 5 <> 0 THEN 'http://host/watch?v=yt' || o_custkey || '&t=1' END"
META = f"meta AS (SELECT video_id AS vid, {_URL} AS url, o_orderkey AS row_idx FROM clips WHERE o_custkey % 9 <> 0)"
AUDIT = "audit AS (SELECT 'yt' || c_custkey AS video, CASE WHEN c_custkey % 4 = 1 THEN '' ELSE '.mp4' END AS ext, c_custkey AS row_idx FROM customer WHERE c_custkey % 6 <> 0)"


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clips(spark, sf_dir).where("o_custkey % 9 <> 0")
    return rows.select(F.col("video_id").alias("vid"), F.expr(_URL).alias("url"), F.col("o_orderkey").alias("row_idx"))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").where("c_custkey % 6 <> 0")
    return rows.select(F.expr("'yt' || c_custkey").alias("video"), F.expr("CASE WHEN c_custkey % 4 = 1 THEN '' ELSE '.mp4' END").alias("ext"), F.col("c_custkey").alias("row_idx"))


# ---- boxes in frames of 854 x 480 ----

WIDTH, HEIGHT = 854, 480
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_BOX = "l_quantity * 16 AS x1, l_discount * 4000 AS y1, l_quantity * 16 + l_tax * 6000 AS x2, l_discount * 4000 + l_linenumber * 60 AS y2"
BOXES = f"boxes AS (SELECT {_KEYS}, {_BOX} FROM lineitem)"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*KEYS, *_BOX.split(", "))


# ---- frame sizes ----

SIZES = "sizes AS (SELECT p_partkey, CAST(160 + p_size * 37 AS INTEGER) AS w, CAST(90 + (p_partkey % 40) * 31 AS INTEGER) AS h FROM part)"


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey", "cast(160 + p_size * 37 as int) as w", "cast(90 + (p_partkey % 40) * 31 as int) as h")


# ---- seeds: seconds of events in a user's day; tracks: events of each user by day of the month ----

SEEDS = (
    "seconds AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS DOUBLE) / 1000000 AS s FROM events),"
    " seeds AS (SELECT user_id, day, list(s ORDER BY s) AS seeds FROM seconds GROUP BY user_id, day)"
)


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    second = (F.unix_micros(ts) - F.unix_micros(F.date_trunc("day", ts))).cast("double") / 1000000
    rows = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), second.alias("s"))
    return rows.groupBy("user_id", "day").agg(F.sort_array(F.collect_list("s")).alias("seeds"))


FRAMES = 30
DAYS = (
    "days AS (SELECT user_id, CAST(day(ts) - 1 AS INTEGER) AS frame, count(*) AS area FROM events WHERE day(ts) <= 30 AND (user_id + day(ts)) % 4 <> 0 GROUP BY ALL),"
    " spine AS (SELECT u.user_id, CAST(f.frame AS INTEGER) AS frame FROM (SELECT DISTINCT user_id FROM days) u, range(0, 30) f(frame)),"
    " frames AS (SELECT s.user_id, s.frame, coalesce(d.area, 0) AS area FROM spine s LEFT JOIN days d USING (user_id, frame))"
)


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("d", F.dayofmonth("ts")).where("d <= 30 AND (user_id + d) % 4 <> 0")
    return rows.groupBy("user_id", (F.col("d") - 1).alias("frame")).agg(F.count("*").alias("area"))


# ---- pools: six successive vectors are a subject's pool, even ones its reference side, odd ones its target side ----

_POOL = "CAST(floor(vec_id / 6) AS BIGINT) AS pool, vec_id % 2 AS side, CAST(floor(vec_id % 6 / 2) AS INTEGER) AS place"
POOLS = f"pools AS (SELECT *, CASE WHEN place = 0 THEN 'annotation' ELSE 'detector' END AS origin FROM (SELECT {_POOL}, embedding FROM embeddings))"


def pools(spark: SparkSession, sf_dir: str, side: int) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(F.col("vec_id") % 2 == side).selectExpr(*_POOL.split(", "), "embedding as vector")
    return rows.select("pool", "place", F.when(F.col("place") == 0, "annotation").otherwise("detector").alias("origin"), "vector")


# ---- gate: subjects are orders by customer, records most of them ----

SUBJECTS = "subjects AS (SELECT 's' || o_custkey AS sample_id, o_orderkey AS subject_id FROM orders)"
_RECORD = (
    "'s' || o_custkey AS sample_id, o_orderkey AS subject_id, o_orderkey AS row_idx,"
    " CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice / 200000 - 0.5 END AS identity,"
    " CASE WHEN o_orderstatus = 'P' THEN 'no_box' ELSE 'dis' END AS pick_ref, CASE WHEN o_orderkey % 13 = 0 THEN 'no_box' ELSE 'dis' END AS pick_seed,"
    " CASE WHEN o_orderstatus = 'P' OR o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey % 100 END AS box_ref, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 90 END AS box_seed"
)
RECORDS = f"records AS (SELECT {_RECORD} FROM orders WHERE o_orderkey % 7 <> 0)"


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("'s' || o_custkey as sample_id", "o_orderkey as subject_id")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0")
    return rows.selectExpr(*(x.strip() for x in _split(_RECORD)))


def _split(fields: str) -> list[str]:
    """Fields of a select list whose parts hold no comma of their own."""
    return [x if " AS " in x else x for x in fields.split(",")]
