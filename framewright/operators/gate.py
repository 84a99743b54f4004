"""Keep or drop each subject on its identity score; missing evidence always drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.text import three_decimals
from framewright.operators.select import last_wins

RULE = "identity_only"


def decide(identity: Column, pick_ref: Column, pick_seed: Column, least: float, rule: str = RULE) -> Column:
    """struct(verdict, gate, reason, identity_ok, box_set); a side without a box drops first, then a missing score, then one below `least`."""
    if rule != RULE:
        raise ValueError(f"unknown rule {rule!r}; expected {RULE!r}")
    no_ref, no_seed = F.coalesce(pick_ref == "no_box", F.lit(False)), F.coalesce(pick_seed == "no_box", F.lit(False))
    sides = F.concat_ws(" and ", F.when(no_ref, F.lit("ref")), F.when(no_seed, F.lit("seed")))
    ok = F.coalesce(identity >= least, F.lit(False))
    boxless = no_ref | no_seed
    reason = (
        F.when(boxless, F.concat(F.lit("no usable box on the "), sides, F.lit(" side")))
        .when(identity.isNull(), "no identity score")
        .otherwise(F.concat(F.lit("identity "), three_decimals(identity), F.when(ok, f" >= {least}").otherwise(f" < {least}")))
    )
    name = lambda c: F.coalesce(c, F.lit("none"))
    return F.struct(
        F.when(boxless | ~ok, "drop").otherwise("keep").alias("verdict"),
        F.when(boxless, "no_box").when(~ok, "identity").alias("gate"),
        reason.alias("reason"),
        ok.alias("identity_ok"),
        F.when((pick_ref == pick_seed) & (pick_ref != "no_box"), pick_ref).otherwise(F.concat(F.lit("ref="), name(pick_ref), F.lit(", target="), name(pick_seed))).alias("box_set"),
    )


def gate(subjects: DataFrame, records: DataFrame, least: float, order: str, keep_all: bool = False) -> DataFrame:
    """Every subject (sample_id, subject_id, ...) with out (whether it is emitted), gate (why not, or the verdict against it), reason, kept_anyway, and the record's boxes.

    Of several records of a subject the last in `order` counts. No record, or a kept subject
    without both boxes, always drops; keep_all emits the others, marked. records: sample_id,
    subject_id, identity, pick_ref, pick_seed, box_ref, box_seed.
    """
    keys = ["sample_id", "subject_id"]
    records = records.withColumn("__key", F.struct(*keys))
    last = last_wins(records.drop(*keys), "__key", [order]).select("__key.*", "identity", "pick_ref", "pick_seed", "box_ref", "box_seed", F.lit(True).alias("__found"))
    out = subjects.join(last, keys, "left").withColumn("__d", decide(F.col("identity"), F.col("pick_ref"), F.col("pick_seed"), least))
    boxes = F.col("box_ref").isNotNull() & F.col("box_seed").isNotNull()
    found, keep = F.col("__found").isNotNull(), F.col("__d.verdict") == "keep"
    anyway = found & ~keep & boxes & F.lit(keep_all)
    return out.withColumns({
        "out": (found & keep & boxes) | anyway,
        "gate": F.when(~found, "no_record").when(~keep, F.col("__d.gate")).when(~boxes, "no_box"),
        "reason": F.when(~found, "no report record").when(~keep, F.col("__d.reason")).when(~boxes, "kept by the rule but a chosen box is missing").otherwise(F.col("__d.reason")),
        "kept_anyway": anyway,
    }).drop("__d", "__found")


def corrected(gated: DataFrame) -> DataFrame:
    """The emitted subjects with the record's boxes in place of their own, tagged as frame space; samples without any vanish."""
    return gated.where("out").withColumns({"ref_box": F.col("box_ref"), "seed_box": F.col("box_seed"), "box_space": F.lit("frame")}).drop("box_ref", "box_seed")


def drops(gated: DataFrame) -> DataFrame:
    """Every verdict against a subject: sample_id, subject_id, gate, reason, identity, kept_anyway."""
    return gated.where("gate is not null").select("sample_id", "subject_id", "gate", "reason", "identity", "kept_anyway")


def funnel(gated: DataFrame) -> DataFrame:
    """One row of counts, in one pass over samples and one over subjects."""
    by_sample = gated.groupBy("sample_id").agg(
        F.count("*").alias("n"), F.count_if("out").alias("kept"), F.count_if(F.col("gate").isNotNull()).alias("against"), F.count_if("kept_anyway").alias("anyway"),
        *(F.count_if(F.col("gate") == g).alias(g) for g in ("no_record", "no_box", "identity")),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by_sample.agg(
        F.count("*").alias("samples_in"), F.count_if(F.col("kept") > 0).alias("samples_out"), F.count_if(F.col("kept") == 0).alias("samples_emptied"),
        total("n").alias("subjects_in"), total("kept").alias("subjects_out"), total("against").alias("subjects_dropped"), total("anyway").alias("subjects_kept_anyway"),
        *(total(g).alias(g) for g in ("no_record", "no_box", "identity")),
    )
