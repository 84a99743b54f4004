"""The pipeline stage by stage against plain versions, each on its own input."""

import duckdb
import pytest

import corpus_pipeline
from framewright.llm import bpe, entry, line_dedup
from tests.llm import brute
from tests.llm.test_operators import spec_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).persist()
        out.append((before.collect(), docs.collect(), docs.columns))
    return out


def test_stages_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    columns = {"doc_id", "text", "lang", "source", "n_chars"}
    assert all(set(c) == columns for _, _, c in stages[:-1])


def test_quality_stage(spark, stages):
    before, after, _ = stages[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert kept < {r.doc_id for r in before}
    known = [r.doc_id for r in before if r.doc_id in labels]
    assert sum((i in kept) == bool(labels[i]) for i in known) / len(known) > 0.9


def test_line_stage(stages):
    before, after, _ = stages[1]
    want = spec_lines([(r.doc_id, r.source, r.text) for r in before], line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert {r.doc_id: r.text for r in after} == dict(want) and all(r.n_chars == len(r.text) for r in after)


def test_near_duplicate_stage(stages):
    before, after, _ = stages[2]
    assert {r.doc_id for r in after} == {i for i, _, c in brute.jaccard([(r.doc_id, r.text) for r in before]) if i == c}


def test_decontamination_stage(spark, stages):
    before, after, _ = stages[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in after} == {i for i, *_, bad in brute.decontam([(r.doc_id, r.text) for r in before], items) if not bad}


def test_encoding_stage(stages):
    before, after, _ = stages[4]
    coder = bpe.load(entry.VOCABULARY)
    got = {r.doc_id: r for r in after}
    for r in before:
        assert bytes(got[r.doc_id].ids) == coder.encode(r.text) and got[r.doc_id].ids_sha256 == brute.sha(coder.encode(r.text))


def test_run(spark, stages):
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id for r in stages[4][1]}


STAGE = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", list(STAGE))
def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs, no_docs, odd_rows, name):
    """Null and empty texts, a text over 1 MB, repeated rows, clashing names, an empty table."""
    got = STAGE[name](spark, odd_docs, SF).collect()
    assert STAGE[name](spark, no_docs, SF).count() == 0
    if name == "BPE encoding and decoding":
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_rows)
        assert all(r.n_tokens == 0 and bytes(r.ids) == b"" for r in got if r.doc_id in (1, 2, 3))
        return
    assert STAGE[name](spark, odd_docs, SF).columns == odd_docs.columns
    assert all(r["__id"] == r["__row"] == r["a.b"] == "mine" and r.n_words == 1 for r in got)
    kept = sorted((str(r.doc_id), str(r.text)) for r in got)
    if name == "quality classifier":
        assert set(kept) <= {(str(i), str(t)) for i, t in odd_rows}
        assert all(kept.count(k) == [(str(i), str(t)) for i, t in odd_rows].count(k) for k in kept)
    elif name == "line dedup":
        want = spec_lines([(i, "src", t) for i, t in odd_rows], line_dedup.RATIO, line_dedup.MIN_PAGES)
        assert kept == sorted((str(i), str(t)) for i, t in want)
    elif name == "n-gram Jaccard join":
        worded = {i for i, n, c in brute.jaccard(odd_rows) if n and i == c}
        assert {r.doc_id for r in got if (r.text or "").strip()} == worded and sum(1 for r in got if not (r.text or "").strip()) == sum(1 for _, t in odd_rows if not (t or "").strip())
        assert len({(r.doc_id, r.text) for r in got if (r.text or "").strip()}) == sum(1 for r in got if (r.text or "").strip())
    else:
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
        bad = {i for i, *_, gone in brute.decontam(odd_rows, items) if gone}
        assert kept == sorted((str(i), str(t)) for i, t in odd_rows if i not in bad)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = entry.queries()[name](spark, SF), duck.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    mine = sorted(str(tuple(r[c] for c in columns)) for r in got.collect())
    assert mine == sorted(str(tuple(r[want.columns.index(c)] for c in columns)) for r in want.fetchall())
