"""Line dedup by site-relative frequency.

A line is boilerplate on a site when the pages of the site that contain it,
divided by the site's page total, exceed a ratio, and at least MIN_PAGES pages
contain it (a line of one page of a one-page site is no boilerplate). Boilerplate
lines are dropped from all pages of the site; other lines keep their order.

Defined results: a null text stays null and has no lines; a null host is a site of
its own; lines without a character other than white space are never boilerplate
and always stay; a line that a page repeats counts once for the page; repeated
rows count as pages of their own; an empty table gives an empty table. Columns
besides the text pass through whatever their names are (the count's name can be chosen, or
left out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import BROADCAST_LIMIT, cut

#: Share of a site's pages that a line must exceed to be boilerplate.
RATIO = 0.05
#: Pages of the site that must contain the line at least.
MIN_PAGES = 5

_BLANK = r"^[\x20\x09-\x0D]*$"


def line_key(line: Column) -> Column:
    """96 bits that stand for a line within its site."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, a, b (line key), pages, total of each boilerplate line. Counts are combined before the shuffle, so a hot site or line costs a row a task."""
    host = F.col(f"`{host_col}`").alias("host")
    lines = F.filter(F.array_distinct(F.split(F.col(f"`{text_col}`"), "\n", -1)), lambda x: ~x.rlike(_BLANK))
    counts = (
        docs.select(host, F.explode(lines).alias("line"))
        .select("host", line_key(F.col("line")).alias("k"))
        .groupBy("host", F.col("k.a").alias("a"), F.col("k.b").alias("b"))
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    totals = docs.groupBy(host).agg(F.count("*").alias("total"))
    return counts.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).where(F.col("pages") > F.col("total") * F.lit(ratio)).drop("h")


def drop_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, limit: int = BROADCAST_LIMIT, count_col: str | None = "__dropped") -> DataFrame:
    """docs with boilerplate lines taken out of the text; count_col, if named, counts the lines that went.

    Each site has at most (mean lines a page) / ratio boilerplate lines, one array row per
    site; that table is broadcast only if its measured size is under the limit, else sites
    are joined by a shuffle whose hot partitions adaptive execution splits.
    """
    found = cut(boilerplate(docs, host_col, text_col, ratio, min_pages).groupBy("host").agg(F.collect_set(F.struct("a", "b")).alias("__lines")))
    size = found.agg(F.sum(F.size("__lines") * 40 + 64)).first()[0] or 0
    # the row stands apart from what is joined, so none of its columns can clash
    rows = docs.select(F.col(f"`{host_col}`").alias("__host"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    joined = rows.join(F.broadcast(found) if size <= limit else found, F.col("__host").eqNullSafe(F.col("host")), "left")
    text = F.col("__row").getField(text_col)
    split = F.split(text, "\n", -1)
    kept = F.filter(split, lambda x: x.rlike(_BLANK) | ~F.array_contains(F.col("__lines"), line_key(x)))
    cleaned = F.when(F.col("__lines").isNull() | text.isNull(), text).otherwise(F.array_join(kept, "\n"))
    n = F.when(F.col("__lines").isNull() | text.isNull(), F.lit(0)).otherwise(F.size(split) - F.size(kept))
    return joined.select(*[(cleaned if c == text_col else F.col("__row").getField(c)).alias(c) for c in docs.columns], *([n.cast("long").alias(count_col)] if count_col else []))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_lines_dropped, n_chars_kept, kept_sha256 of every document."""
    return drop_lines(docs.select("doc_id", "source", "text")).select(
        "doc_id",
        "source",
        F.col("__dropped").alias("n_lines_dropped"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars_kept"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
