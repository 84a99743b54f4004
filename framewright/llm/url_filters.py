"""URL filters: hand-written rules first, then a path-template tree with labelled purity.

Each host has a tree of path segments. Segments that are numbers or hexadecimal ids are
generalised by their form. Then the tree is generalised level by level from the root:
where a place, below parents that are generalised already, has many literal children that
hardly recur, they become one wildcard, and what is below them becomes one branch.

A branch whose labelled purity does not differ statistically from its parent's is merged
into it. Of those that do, siblings on the same side of their parent are merged with each
other where they do not differ from what they are together. A template is judged by its
deepest branch that stands out, and rejected when that branch's smoothed share of good
labels is under a threshold. DataFrame functions only; every step aggregates before it
shuffles, so a hot host costs a row per template and task.

The tree has DEPTH levels at most; what follows is one last segment, so the work is
linear in a path's length and the number of rounds bounded.

Defined results: a null url, or one without ://, has an empty host and path; a host
without labels has the overall purity; without any labels nothing is rejected; repeated
rows count as pages each; an empty table gives an empty one; other columns (html) are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import ascii_lower, cut, join_checked

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with its own; the longest wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A place of the tree is variable with so many literal children, if they have at most so many pages each on average.
CHILDREN, PAGES_EACH = 20, 2
#: Levels of the tree; the rest of a longer path is the last level's segment.
DEPTH = 32
#: Standard errors by which a branch must differ from its parent, or from its siblings together, to stand alone.
Z = 2.0
#: Pages of overall purity that smooth each branch, and the least purity of an allowed template.
PRIOR, PURITY = 10.0, 0.5


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, action).otherwise(verdict)
    return name, verdict


def form_of(segment: Column) -> Column:
    """A segment generalised by its form."""
    return (
        F.when(segment.rlike(r"^[0-9]+$"), F.lit("<n>"))
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z0-9]+$"), F.concat(F.lit("<n>."), F.substring_index(segment, ".", -1)))
        .when(segment.rlike(r"^[0-9a-fA-F-]{8,}$") & segment.rlike("[0-9]"), F.lit("<x>"))
        .otherwise(segment)
    )


def form_path(path: Column) -> Column:
    """The path's segments, each by its form, joined by /."""
    return F.array_join(F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), form_of), "/")


def _segments(form: str) -> Column:
    return F.when(F.col(form) == "", F.array().cast("array<string>")).otherwise(F.split(F.col(form), "/", DEPTH))


def templates(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """host, form, template of every distinct form of path. One round a level, each of an aggregation and a join with the variable places it has found."""
    url = F.col(f"`{url_col}`")
    forms = cut(pages.select(host_of(url).alias("host"), form_path(path_of(url)).alias("form")).groupBy("host", "form").agg(F.count("*").alias("pages")))
    rows = forms.select("host", "form", "pages", _segments("form").alias("s"), F.lit("").alias("template"))
    levels = rows.agg(F.max(F.size("s"))).first()[0] or 0
    for level in range(levels):
        seg = F.get("s", F.lit(level))
        literal = ~seg.startswith("<")
        variable = cut(
            rows.where(seg.isNotNull() & literal)
            .groupBy("host", "template", seg.alias("seg"))
            .agg(F.sum("pages").alias("p"))
            .groupBy("host", "template")
            .agg(F.count("*").alias("children"), F.sum("p").alias("p"))
            .where((F.col("children") >= CHILDREN) & (F.col("p") <= F.col("children") * PAGES_EACH))
            .select("host", "template", F.lit(True).alias("any"))
        )
        if variable.isEmpty():
            rows = rows.withColumn("any", F.lit(False))
        else:
            rows = join_checked(rows, variable, ["host", "template"], F.length("host") + F.length("template") + 40)
        own = F.when(F.col("any") & literal, F.lit("*")).otherwise(seg)
        longer = F.when(F.col("template") == "", own).otherwise(F.concat("template", F.lit("/"), own))
        rows = rows.select("host", "form", "pages", "s", F.when(seg.isNull(), F.col("template")).otherwise(longer).alias("template"))
    return rows.select("host", "form", "template")


def _smoothed(good: str, n: str, base: float) -> Column:
    return (F.col(good) + PRIOR * base) / (F.col(n) + PRIOR)


def branches(marked: DataFrame, base: float) -> DataFrame:
    """host, d, prefix, purity of the branches that stand out, the root among them; marked: host, template, good, n."""
    depths = F.sequence(F.lit(0), F.size(_segments("template")))
    nodes = cut(
        marked.select("host", "template", "good", "n", F.explode(depths).alias("d"))
        .select("host", "d", _prefix(F.col("d")).alias("prefix"), _prefix(F.col("d") - 1).alias("above"), "good", "n")
        .groupBy("host", "d", "prefix", "above")
        .agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    )
    up = nodes.select("host", (F.col("d") + 1).alias("d"), F.col("prefix").alias("above"), F.col("good").alias("up_good"), F.col("n").alias("up_n"))
    own, parent = (F.col("good") + 1) / (F.col("n") + 2), (F.col("up_good") + 1) / (F.col("up_n") + 2)

    def differs(a: Column, b: Column) -> Column:
        return F.abs(a - b) > Z * F.sqrt(b * (1 - b) / (F.col("n") + 2))

    standing = nodes.join(up, ["host", "d", "above"], "left").where((F.col("d") == 0) | differs(own, parent))
    standing = cut(standing.select("host", "d", "prefix", "above", "good", "n", F.coalesce(own > parent, F.lit(True)).alias("side")))
    beside = ["host", "d", "above", "side"]
    together = standing.groupBy(*beside).agg(F.sum("good").alias("all_good"), F.sum("n").alias("all_n"))
    pooled = (F.col("all_good") + 1) / (F.col("all_n") + 2)
    joined = standing.join(together, beside)
    return joined.select("host", "d", "prefix", F.when(differs(own, pooled), _smoothed("good", "n", base)).otherwise(_smoothed("all_good", "all_n", base)).alias("purity"))


def _prefix(depth: Column) -> Column:
    """The first segments of the column template, as text."""
    return F.when(depth <= 0, F.lit("")).otherwise(F.array_join(F.slice(_segments("template"), F.lit(1), F.greatest(depth, F.lit(0))), "/"))


def rejected(pages: DataFrame, labelled: DataFrame, url_col: str = "url") -> DataFrame:
    """host, form of the path forms whose template is rejected; cut. labelled: url, good (boolean), a row for each labelled page."""
    found = cut(templates(pages, url_col))
    marks = labelled.select(host_of(F.col("url")).alias("host"), form_path(path_of(F.col("url"))).alias("form"), F.col("good").cast("long").alias("g"))
    marks = marks.groupBy("host", "form").agg(F.sum("g").alias("good"), F.count("g").alias("n"))
    marked = cut(marks.join(found, ["host", "form"]).groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("n").alias("n")))
    good, n = marked.agg(F.sum("good"), F.sum("n")).first()
    nodes = branches(marked, (good or 0) / n if n else 1.0)
    every = found.select("host", "template").distinct().select("host", "template", F.explode(F.sequence(F.lit(0), F.size(_segments("template")))).alias("d"))
    every = every.select("host", "template", "d", _prefix(F.col("d")).alias("prefix"))
    judged = every.join(nodes, ["host", "d", "prefix"]).groupBy("host", "template").agg(F.max_by("purity", "d").alias("purity"))
    return cut(found.join(judged.where(F.col("purity") < PURITY), ["host", "template"]).select("host", "form"))


def judge(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """id, host, path, rule, verdict of every page. The rejected forms are broadcast only if their measured size allows it."""
    url = F.col(f"`{url_col}`")
    bad = rejected(pages, labelled, url_col).withColumn("bad", F.lit(True))
    rows = pages.select(F.col(f"`{id_col}`").alias("__doc"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("form", form_path(F.col("path")))
    rows = join_checked(rows, bad, ["host", "form"], F.length("host") + F.length("form") + 48)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(F.col("__doc").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


def labels_by_number(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """url, good of the pages whose path ends in the number of a labelled document (good: quality 1 and not toxic)."""
    number = F.expr(f"try_cast(nullif(regexp_extract({url_col}, '/([0-9]+)([.][a-z]+)?/?([?#].*)?$', 1), '') as bigint)")
    marks = labels.groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return pages.select(F.col(url_col).alias("url"), number.alias("doc_id")).join(marks, "doc_id").select("url", "good")
