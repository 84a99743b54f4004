"""Quality rules: a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

The unigrams and bigrams of a text's lower-cased words are hashed into buckets, whose number
grows with the cube root of the corpus. Two multinomials over the buckets, of the trusted
documents and of all documents, give each bucket a log-likelihood ratio; a document's
score is the mean over its n-grams, so length does not count. It is kept when the
score is at least THRESHOLD and the base rules hold. DataFrame functions only: n-grams
are counted and scored as rows, combined before every shuffle, and the table of ratios is
broadcast only under a measured size.

Defined results: null and empty texts have no words, fail the base rules and score 0;
repeated ids among the trusted count once; repeated rows count as documents each and
get the same result; without trusted documents all scores are 0 and the base rules alone
decide; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import KEY, cut, join_checked, row_key, total_bytes

#: Buckets of the hashed n-grams for each unit of the cube root of the corpus's bytes (then rounded up to a power of two): 2^13 for 2 MB, 2^16 for 1.5 GB, 2^22 for 100 TB.
BUCKETS_EACH = 32
#: Largest table of ratios that is broadcast.
TABLE_LIMIT = 128 << 20
#: Added to every bucket's count among the trusted, and its like in all documents.
SMOOTHING = 1.0
#: Least mean log-likelihood ratio (nats an n-gram) of a kept document.
THRESHOLD = -0.15
SYMBOLS = "#*$%&|<>"  # stands inside a character class
SPACES = " \t\n\x0b\f\r"
#: Words of the windows whose repetition counts.
REPEAT = 5


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def bucket_count(text_bytes: int) -> int:
    return 1 << max(10, math.ceil(math.log2(BUCKETS_EACH * max(1, text_bytes) ** (1 / 3))))


def grams(docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """KEY and b, the bucket of each unigram and bigram: a row for each of them."""
    bucket = lambda x: F.pmod(x, F.lit(buckets)).cast("int")
    rows = docs.select(*row_key(docs, id_col, text_col)).select(*KEY, hashes_of(words_of(F.lower("__text"))).alias("h"))
    pairs = F.zip_with("h", F.slice("h", F.lit(2), F.size("h")), lambda a, b: bucket(F.xxhash64(a, b)))
    both = F.concat(F.transform("h", bucket), F.when(F.size("h") > 1, F.slice(pairs, F.lit(1), F.size("h") - 1)).otherwise(F.array().cast("array<int>")))
    return rows.select(*KEY, F.explode(both).alias("b"))


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """b, ratio: the log-likelihood ratio of each bucket in use; cut. trusted: a column of ids, the target."""
    target = cut(trusted.select(F.col(trusted.columns[0]).cast("long").alias("__id")).where("__id is not null").distinct().withColumn("__t", F.lit(1)))
    marked = join_checked(grams(docs, buckets, id_col, text_col), target, ["__id"], F.lit(32))
    counts = cut(marked.groupBy("b").agg(F.count("*").alias("raw"), F.count("__t").alias("target")))
    raw, good = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not good:
        return counts.select("b", F.lit(0.0).alias("ratio"))
    # the pseudo-counts of both multinomials are in the proportion of their totals, so a bucket that is rare in both says little
    ratio = F.log((F.col("target") + SMOOTHING) / (F.col("raw") * (good / raw) + SMOOTHING))
    return cut(counts.select("b", ratio.alias("ratio")))


def scores(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """KEY, score of every distinct document that has words; cut."""
    buckets = bucket_count(total_bytes(docs, text_col))
    table = ratios(docs, trusted, buckets, id_col, text_col)
    rows = join_checked(grams(docs, buckets, id_col, text_col), table, ["b"], F.lit(24), "inner", TABLE_LIMIT)
    return cut(rows.groupBy(*KEY).agg(F.avg("ratio").alias("score")))


def base_rules(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    no_longs = F.array().cast("array<bigint>")
    out = rows.select(
        "*",
        words_of(text).alias("__w"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        lines.alias("__lines"),
    )
    out = out.withColumns({"__h": hashes_of(F.col("__w")), "word_chars": F.length(F.array_join("__w", "")).cast("long")}).drop("__w")
    out = out.select(
        *[c for c in out.columns if c not in ("__h", "__lines")],
        F.size("__h").cast("long").alias("n_words"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("__h") >= REPEAT,
            F.transform(F.sequence(F.lit(0), F.size("__h") - REPEAT), lambda i: F.xxhash64(*(F.col("__h")[i + k] for k in range(REPEAT)))),
        ).otherwise(no_longs).alias("__win"),
    )
    # only texts with a window that recurs pay for the sort
    places = F.zip_with("__win", F.sequence(F.lit(0), F.size("__win") - 1), lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    out = out.withColumn("__s", F.when(F.size(F.array_distinct("__win")) < F.size("__win"), F.sort_array(places)))
    s = F.col("__s")
    again = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
    out = out.withColumn("__p", F.sort_array(F.transform(again, lambda x: x["p"])))
    steps = F.zip_with("__p", F.slice("__p", F.lit(2), F.size("__p")), lambda a, b: F.least(F.lit(REPEAT), F.coalesce(b - a, F.lit(REPEAT))))
    covered = F.when(F.col("__p").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), lambda a, x: a + x))
    out = out.withColumn("n_repeat_words", covered.cast("long")).drop("__win", "__s", "__p")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept of every document."""
    rows = base_rules(docs.select(F.col(f"`{id_col}`").alias("__doc"), *row_key(docs, id_col, text_col)), "__text").drop("__text")
    rows = join_checked(rows, scores(docs, trusted, id_col, text_col), KEY, F.lit(48)).withColumn("score", F.coalesce("score", F.lit(0.0)))
    return rows.select(
        F.col("__doc").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score",
        (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"),
    )
