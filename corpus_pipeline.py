"""A corpus pipeline: quality classifier, line dedup, near-duplicate join, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of docs. run() writes each stage's rows as Parquet into the shared folder
and reads them again as the next one's docs, so a lost executor never costs more than
the stage at hand; a stage's input is removed when the last one is written. No stage is
expressible in SQL as a whole (the first fits a model).

Defined results, in every stage: an empty table gives an empty one (its columns kept);
extra columns pass through whatever their names are; texts of any length are taken
whole; rows with a null doc_id are rows like others. Each stage's docstring tells what
becomes of null and empty texts, ties and repeated rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import bpe, decontam, jaccard_join, line_dedup, quality_classifier
from framewright.llm.common import remove, shared_dir
from framewright.llm.entry import VOCABULARY, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents (score under 0.5) go. Null and empty texts are scored as empty ones; a score of exactly 0.5 stays; repeated rows share a verdict; without labels all stay."""
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; n_chars follows the text. Null texts stay null, empty ones empty; a null source is a source; a repeated row counts as a page of its own; a ratio of exactly the limit stays."""
    kept = line_dedup.drop_lines(docs, count_col=None)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the least doc_id (null before all), of repeated rows one. Rows without words all stay."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, of repeated rows all. Null and empty texts are clean; one hit word in exactly twenty goes."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of the ids and of the decoded text, a row for each row. Null and empty texts have no tokens."""
    return bpe.encode(docs, VOCABULARY).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    for number in range(len(STAGES) - 1):
        remove(spark, f"{folder}/{number}")
    return docs
