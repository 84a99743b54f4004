"""The opN_ queries over the driver's tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from framewright.llm import bpe, decontam, jaccard_join, line_dedup, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_shards, url_filters

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules.judge(table(spark, sf_dir, "documents"), trusted).drop("score")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.assign(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, url_filters.labels_by_number(pages, table(spark, sf_dir, "labels")))


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.materialise(table(spark, sf_dir, "documents"), VOCABULARY)


_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format("text")} AS w FROM benchmark),
item_window AS (
  SELECT item_id, k, array_to_string(list_slice(w, p0, p0 + k - 1), ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(generate_series(1, greatest(1, len(w) - 12))) AS p0 FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT k FROM item_window),
doc AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
doc_window AS (
  SELECT doc_id, k, p0, array_to_string(list_slice(w, p0, p0 + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p0 FROM doc, size WHERE len(w) >= k)),
hit AS (SELECT d.doc_id, d.p0, d.k, i.item_id FROM doc_window d JOIN item_window i ON d.k = i.k AND d.win = i.win),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p0, p0 + k - 1)) AS pos FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(f.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

OP5_SQL = r"""
WITH line AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS at FROM documents),
page AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
common AS (
  SELECT l.source, l.line FROM (SELECT DISTINCT doc_id, source, line FROM line WHERE NOT regexp_full_match(line, '[\x20\x09-\x0D]*')) l
  JOIN page p ON p.source IS NOT DISTINCT FROM l.source
  GROUP BY l.source, l.line, p.total HAVING count(*) >= 5 AND count(*) > p.total * CAST(0.05 AS DOUBLE)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.at) AS text, count(*) AS n
  FROM line l LEFT JOIN common c ON c.source IS NOT DISTINCT FROM l.source AND c.line = l.line WHERE c.line IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, d.source, CAST(coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n, 0) AS BIGINT) AS n_lines_dropped,
  CAST(length(coalesce(k.text, '')) AS BIGINT) AS n_chars_kept, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


OP4_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p0, array_to_string(list_slice(w, p0, p0 + 19), ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS p0 FROM doc WHERE len(w) >= 20)),
late AS (SELECT doc_id, p0 FROM win QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, p0) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p0, p0 + 19)) AS pos FROM late),
word AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM doc),
kept AS (SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.pos) AS text, count(*) AS n FROM word w LEFT JOIN gone g USING (doc_id, pos) WHERE g.pos IS NULL GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc d LEFT JOIN kept k USING (doc_id)
"""


OP7_SQL = r"""
WITH RECURSIVE doc AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p0, p0 + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p0 FROM doc WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT c.u, c.v FROM common c JOIN size a ON a.doc_id = c.u JOIN size b ON b.doc_id = c.v WHERE 100 * c.o >= 80 * (a.n + b.n - c.o)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN link l ON l.u = r.v)
SELECT r.u AS doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(r.v) AS component_id FROM reach r LEFT JOIN size s ON s.doc_id = r.u GROUP BY r.u
"""


OP9_SQL = r"""
WITH RECURSIVE page AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    TRY_CAST(nullif(regexp_extract(url, '/([0-9]+)([.][a-z]+)?/?([?#].*)?$', 1), '') AS BIGINT) AS doc_id FROM pages),
formed AS (
  SELECT *, array_to_string(list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda s:
    CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '<n>' WHEN regexp_matches(s, '^[0-9]+\.[A-Za-z0-9]+$') THEN '<n>.' || string_split(s, '.')[-1]
    WHEN regexp_matches(s, '^[0-9a-fA-F-]{8,}$') AND regexp_matches(s, '[0-9]') THEN '<x>' ELSE s END), '/') AS form FROM page),
forms AS (SELECT host, form, count(*) AS pages, CASE WHEN form = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(form, '/') END AS whole FROM formed GROUP BY host, form),
bounded AS (SELECT host, form, pages, CASE WHEN len(whole) > 32 THEN list_append(whole[1:31], array_to_string(whole[32:], '/')) ELSE whole END AS s FROM forms),
grown AS (
  SELECT host, form, pages, s, 0 AS i, '' AS template FROM bounded UNION ALL
  SELECT host, form, pages, s, i + 1, CASE WHEN i = 0 THEN '' ELSE template || '/' END || CASE WHEN seg NOT LIKE '<%' AND children >= 20 AND p <= 2 * children THEN '*' ELSE seg END
  FROM (SELECT *, count(DISTINCT seg) FILTER (seg NOT LIKE '<%') OVER (PARTITION BY host, template) AS children, sum(pages) FILTER (seg NOT LIKE '<%') OVER (PARTITION BY host, template) AS p
    FROM (SELECT *, s[i + 1] AS seg FROM grown WHERE i < len(s)))),
template AS (SELECT host, form, template FROM grown WHERE i = len(s)),
mark AS (SELECT doc_id, bool_and(quality = 1 AND toxic = 0) AS good FROM labels GROUP BY doc_id),
marked AS (SELECT t.host, t.template, sum(CAST(m.good AS BIGINT)) AS good, count(*) AS n FROM formed f JOIN mark m ON m.doc_id = f.doc_id JOIN template t ON t.host = f.host AND t.form = f.form GROUP BY ALL),
base AS (SELECT coalesce(sum(good) / sum(n), 1.0) AS b FROM marked),
leaf AS (
  SELECT host, template, CASE WHEN len(whole) > 32 THEN list_append(whole[1:31], array_to_string(whole[32:], '/')) ELSE whole END AS s
  FROM (SELECT DISTINCT host, template, CASE WHEN template = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(template, '/') END AS whole FROM template)),
every AS (SELECT host, template, d, array_to_string(s[1:d], '/') AS prefix, CASE WHEN d <= 1 THEN '' ELSE array_to_string(s[1:d - 1], '/') END AS above FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM leaf)),
node AS (SELECT e.host, e.d, e.prefix, e.above, sum(m.good) AS good, sum(m.n) AS n FROM every e JOIN marked m ON m.host = e.host AND m.template = e.template GROUP BY ALL),
apart AS (
  SELECT c.host, c.d, c.prefix, c.above, c.good, c.n, coalesce((c.good + 1) / (c.n + 2) > (u.good + 1) / (u.n + 2), true) AS side
  FROM node c LEFT JOIN node u ON u.host = c.host AND u.d + 1 = c.d AND u.prefix = c.above
  WHERE c.d = 0 OR abs((c.good + 1) / (c.n + 2) - (u.good + 1) / (u.n + 2)) > 2.0 * sqrt((u.good + 1) / (u.n + 2) * (1 - (u.good + 1) / (u.n + 2)) / (c.n + 2))),
beside AS (SELECT *, sum(good) OVER w AS all_good, sum(n) OVER w AS all_n FROM apart WINDOW w AS (PARTITION BY host, d, above, side)),
standing AS (
  SELECT host, d, prefix, CASE WHEN abs((good + 1) / (n + 2) - (all_good + 1) / (all_n + 2)) > 2.0 * sqrt((all_good + 1) / (all_n + 2) * (1 - (all_good + 1) / (all_n + 2)) / (n + 2))
    THEN (good + 10.0 * (SELECT b FROM base)) / (n + 10.0) ELSE (all_good + 10.0 * (SELECT b FROM base)) / (all_n + 10.0) END AS purity FROM beside),
judged AS (SELECT e.host, e.template, arg_max(s.purity, e.d) AS purity FROM every e JOIN standing s ON s.host = e.host AND s.d = e.d AND s.prefix = e.prefix GROUP BY ALL),
bad AS (SELECT t.host, t.form FROM template t JOIN judged j ON j.host = t.host AND j.template = t.template WHERE j.purity < 0.5),
rule AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) r(verdict, h, p)),
hit AS (
  SELECT f.page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.verdict, length(r.h || r.p)) AS verdict
  FROM page f JOIN rule r ON (f.host = r.h OR ends_with(f.host, '.' || r.h)) AND starts_with(f.path, r.p) GROUP BY f.page_id)
SELECT f.page_id, f.host, f.path, h.rule, coalesce(h.verdict, CASE WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM formed f LEFT JOIN hit h USING (page_id) LEFT JOIN bad b ON b.host = f.host AND b.form = f.form
"""


def queries():
    return {f.__name__: f for f in (op1_bpe, op2_decontamination, op3_quality_classifier, op4_substring_dedup, op5_line_dedup, op6_quality_rules, op7_jaccard_join, op8_suffix_dedup, op9_url_filters, op10_token_shards)}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op4_substring_dedup": OP4_SQL, "op5_line_dedup": OP5_SQL, "op7_jaccard_join": OP7_SQL, "op9_url_filters": OP9_SQL}
