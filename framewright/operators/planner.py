"""Clip annotations to specs: the first reason against a row, or its window and subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.ids import EPS, FPS, WINDOW_FRAMES, clip_end, clip_source, clip_start, frame_time, sample_id, seed_index
from framewright.functions.rounding import round_exact
from framewright.operators.coverage import with_window
from framewright.operators.lookup import with_object_key
from framewright.operators.unnest import box_of, entries, malformed, parsed

REASONS = ("clip_too_short", "no_usable_subject", "no_window_covers_any_seed", "bos_unresolved", "no_subject_with_resolved_ref")


def outcomes(rows: DataFrame, meta: DataFrame, audit: DataFrame, clip: str = "video_id", text: str = "cross_pair", frames: int = WINDOW_FRAMES, fps: int = FPS) -> DataFrame:
    """rows with reason (null: accepted), window_start, sample_id, source_key_found, subjects and dropped.

    A row stays one row throughout; only the references' lookup takes phrases apart, and it
    puts them together again by clip and text, so that a row given twice has its subjects
    once in each copy. Short clips' text is never parsed.
    """
    length = frames / fps
    out = rows.withColumns({"__h": F.xxhash64(text), "__t": F.hash(text), "__start": clip_start(F.col(clip)), "__end": clip_end(F.col(clip))})
    out = out.withColumn("__short", F.col("__end") - F.col("__start") < length - EPS)
    out = out.withColumn("__p", F.when(~F.col("__short"), parsed(F.col(text)))).withColumn("__e", entries(F.col("__p")))
    out = out.withColumn("__m", F.transform("__e", lambda e: malformed(e, F.col(clip))))
    out = out.withColumn("__usable", F.filter("__e", lambda e, i: F.get("__m", i).isNull()))
    bad = F.zip_with("__e", "__m", lambda e, m: F.when(m.isNotNull(), F.struct(e["phrase"].alias("phrase"), F.lit("malformed_annotation").alias("reason"), m.alias("detail"), F.lit(None).cast("double").alias("seed_abs_time"))))
    out = out.withColumn("__bad", F.filter(bad, lambda x: x.isNotNull()))
    out = out.withColumn("__seeds", F.transform("__usable", lambda u: frame_time(F.col("__start"), F.col("__end"), F.get(u["targets"], F.lit(0))["frame_idx"])))
    out = with_window(out.withColumn("__seeds", F.coalesce("__seeds", F.array().cast("array<double>"))), "__start", "__end", "__seeds", length)
    out = with_object_key(out, meta, audit, clip, "object_key")
    # outer, so that no filter on the computed array is pushed down and computed twice
    refs = out.select(F.col(clip).alias("__c"), F.col("__h").alias("__ch"), F.col("__t").alias("__ct"), F.posexplode_outer("covered").alias("offset", "at"), "__usable", "__seeds", "window_start").where("at is not null")
    refs = refs.select("__c", "__ch", "__ct", "offset", F.get("__usable", F.col("at")).alias("u"), F.get("__seeds", F.col("at")).alias("seed"), "window_start")
    refs = refs.withColumns({"t": F.get("u.targets", F.lit(0)), "r": F.get("u.refs", F.lit(0))}).withColumn("ref_vid", F.col("r.vid"))
    refs = with_object_key(refs, meta, audit, "ref_vid", "ref_key")
    subject = F.struct(
        F.col("offset"), F.col("u.phrase").alias("phrase"), F.col("t.bbox_cls").alias("bbox_cls"), seed_index(F.col("seed"), F.col("window_start"), fps, frames).alias("seed_frame_index"),
        round_exact(F.col("seed"), 6).alias("seed_abs_time"), box_of(F.col("t.bbox_loc")).alias("seed_box"), F.col("ref_key"),
        round_exact(frame_time(clip_start(F.col("ref_vid")), clip_end(F.col("ref_vid")), F.col("r.frame_idx")), 6).alias("ref_abs_time"),
        box_of(F.col("r.bbox_loc")).alias("ref_box"), F.col("r.bbox_cls").alias("ref_bbox_cls"), F.col("ref_vid"), F.col("r.scores").alias("ref_score"),
    )
    refs = refs.select("__c", "__ch", "__ct", F.when(F.col("ref_key").isNotNull(), subject).alias("s"), F.when(F.col("ref_key").isNull(), F.struct("offset", F.col("u.phrase").alias("phrase"))).alias("lost"))
    refs = refs.groupBy("__c", "__ch", "__ct").agg(F.sort_array(F.collect_set("s")).alias("subjects"), F.sort_array(F.collect_set("lost")).alias("__lost"))
    out = out.join(refs, (out[clip] == refs["__c"]) & (out["__h"] == refs["__ch"]) & (out["__t"] == refs["__ct"]), "left")

    def drop(phrase, reason, seed=None):
        seed = F.lit(None).cast("double") if seed is None else seed
        return F.struct(phrase.alias("phrase"), F.lit(reason).alias("reason"), F.lit(None).cast("string").alias("detail"), seed.alias("seed_abs_time"))

    outside = F.transform("dropped", lambda i: drop(F.get("__usable", i)["phrase"], "seed_outside_window", F.get("__seeds", i)))
    lost = F.transform("__lost", lambda x: drop(x["phrase"], "ref_bos_unresolved"))
    out = out.withColumn(
        "reason",
        F.when(F.col("__short"), REASONS[0])
        .when(F.coalesce(F.size("__usable"), F.lit(0)) <= 0, REASONS[1])
        .when(F.col("window_start").isNull(), REASONS[2])
        .when(F.col("object_key").isNull(), REASONS[3])
        .when(F.size("subjects") <= 0, REASONS[4]),
    )
    out = out.withColumns({
        "dropped": F.when(F.col("reason").isNull(), F.concat("__bad", outside, F.coalesce(lost, F.array().cast("array<struct<phrase:string,reason:string,detail:string,seed_abs_time:double>>")))),
        # numbers are dense again after references were dropped
        "subjects": F.when(F.col("reason").isNull(), F.transform("subjects", lambda s, i: s.withField("subject_id", i + 1).dropFields("offset"))),
        "sample_id": F.when(F.col("reason").isNull(), sample_id(clip_source(F.col(clip)), F.col("window_start"))),
        "window_end": F.when(F.col("reason").isNull(), round_exact(F.col("window_start") + length, 6)),
        "clip_start": F.col("__start"), "clip_end": F.col("__end"),
    }).withColumn("window_start", F.when(F.col("reason").isNull(), F.col("window_start")))
    return out.drop("covered", *(c for c in out.columns if c.startswith("__")))


def counted(outcomes: DataFrame, *keep: str) -> DataFrame:
    """What the funnel needs of each outcome: reason, n_subjects and drops (the reasons of dropped subjects, of accepted rows only), beside the columns kept."""
    accepted = F.col("reason").isNull()
    return outcomes.select(*keep, "reason", F.when(accepted, F.size("subjects")).alias("n_subjects"), F.when(accepted, F.col("dropped.reason")).alias("drops"))


def funnel(considered: DataFrame) -> DataFrame:
    """kind, name, n: rejected rows by reason, accepted rows, subjects in all and by sample, dropped subjects by reason; of rows from `counted`, in one pass over them.

    Totals are there even if they are 0.
    """
    accepted = F.col("reason").isNull()
    entry = lambda kind, name, n=None: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), (F.lit(1) if n is None else n).cast("long").alias("n"))
    one = F.lit(1)
    total = [entry("total", F.lit("sources_considered")), entry("total", F.lit("samples"), F.when(accepted, one).otherwise(0)), entry("total", F.lit("subjects_total"), F.coalesce("n_subjects", F.lit(0)))]
    more = F.when(accepted, F.concat(F.array(entry("subjects", F.col("n_subjects"))), F.transform(F.coalesce("drops", F.array().cast("array<string>")), lambda r: entry("dropped", r))))
    rows = considered.select(F.explode(F.concat(F.array(*total), F.coalesce(more, F.array(entry("rejected", F.col("reason")))))).alias("e")).select("e.*")
    zeros = considered.sparkSession.createDataFrame([("total", name, 0) for name in ("sources_considered", "samples", "subjects_total")], "kind string, name string, n long")
    return rows.unionByName(zeros).groupBy("kind", "name").agg(F.sum("n").alias("n"))
