"""The operators against plain versions, exact round trips and odd inputs."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from framewright.llm import bpe, bulk_bpe, components, decontam, jaccard_join, line_dedup, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_shards, url_filters
from tests.llm import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def by_text(rows):
    return sorted(rows, key=str)


# ---- 1 BPE ----


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x17F), st.characters(max_codepoint=0x2FFF, exclude_categories=["Cn", "Cs"])), max_size=40))
def test_bpe_like_the_library(text):
    own, library = bpe.load(PATH), Tokenizer.from_file(PATH) if not hasattr(test_bpe_like_the_library, "t") else test_bpe_like_the_library.t
    test_bpe_like_the_library.t = library
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["I'll DON'T 'S<|endoftext|>x<|startoftext|> <|endoftext|", "ΟΔΟΣ ΣΑΣ İ", "é e\u0301 ½ Ⅷ ٣ 漢字", "", "ab" * 4000, "a\x1cb\x85c"])
def test_bpe_odd_texts(library, text):
    own = bpe.load(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
    assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_cache_turns_over(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    own = bpe.WordBPE(PATH)
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)) * 2
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids and len(own) <= 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x2FFF, exclude_categories=["Cn", "Cs"]), max_size=70), max_size=8))
def test_bulk_bpe_gives_the_same_ids(texts):
    own, bulk = bpe.load(PATH), bulk_bpe.load(PATH)
    texts = [*texts, "thistle <|endoftext|>don't", "ab" * 60]
    assert [np.frombuffer(x, "<u2").tolist() for x in bulk.encode(texts)] == [np.frombuffer(own.encode(t), "<u4").tolist() for t in texts]


def test_bulk_bpe_cache_turns_over():
    own, bulk = bpe.load(PATH), bulk_bpe.BulkBPE(bpe.load(PATH), cache_words=7)
    for k in range(30):
        text = " ".join(f"w{chr(97 + (k * j) % 26)}x{chr(97 + j)}" for j in range(9))
        assert np.frombuffer(bulk.encode([text])[0], "<u2").tolist() == np.frombuffer(own.encode(text), "<u4").tolist()
    assert len(bulk.young) + len(bulk.old) < 60


def test_bpe_digests(spark, odd_docs, odd_rows, no_docs, library):
    want = []
    for i, t in odd_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(library.decode(ids, skip_special_tokens=False))))
    assert rows_of(bpe.digests(odd_docs, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == by_text(want)
    assert bpe.digests(no_docs, PATH).count() == 0


# ---- 2 decontamination ----

ITEMS = [(1, " ".join(f"s{i}" for i in range(10, 40))), (2, "S3 s4, s5"), (3, None), (4, "?!"), (10, "s3 s4 s5"), (11, "é漢🙂")]


def test_decontamination(spark, odd_docs, odd_rows, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontam.digests(odd_docs, items), *columns) == by_text(brute.decontam(odd_rows, ITEMS))
    assert decontam.digests(no_docs, items).count() == 0
    assert rows_of(decontam.digests(odd_docs, items.where("false")), *columns) == by_text(brute.decontam(odd_rows, []))
    clean = {i for i, *_, bad in brute.decontam(odd_rows, ITEMS) if not bad}
    kept = decontam.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == clean


def test_spans_lie_in_the_original():
    text = "Ä say: S3,\ts4 -- s5! s3"
    n, runs, found = decontam.Benchmark([("x", "s3 s4 s5")]).scan([text])[0]
    a, b = decontam.original_spans(text, runs)
    assert (n, runs, found) == (6, [(2, 5)], {0}) and text.encode()[a:b].decode() == "S3,\ts4 -- s5"


@pytest.mark.parametrize(("pass_bytes", "held"), [(1 << 20, 100), (150, 1 << 20)])
def test_large_benchmarks_go_in_parts_and_passes(spark, odd_docs, odd_rows, no_docs, monkeypatch, pass_bytes, held):
    monkeypatch.setattr(decontam, "PART_WINDOWS", 7)
    monkeypatch.setattr(decontam, "PASS_BYTES", pass_bytes)
    monkeypatch.setattr(decontam, "HELD_BYTES", held)
    rng = random.Random(11)
    items = [*ITEMS, *((100 + i, " ".join(rng.choice("ab") for _ in range(rng.randrange(3, 30)))) for i in range(12))]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontam.passes(table, "item_id", "text")) == 1 or pass_bytes == 150
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.decontam(odd_rows, items)
    assert rows_of(decontam.digests(odd_docs, table), *columns) == by_text(want)
    assert decontam.digests(no_docs, table).count() == 0
    kept = decontam.clean(odd_docs, table)
    assert kept.columns == odd_docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(i for i, *_, bad in want if not bad)


# ---- 3 quality classifier ----


def quality_rows(n=900, seed=1):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta"]
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        size = rng.randrange(15, 80)
        text = " ".join(rng.choice(words) for _ in range(size)) + "." if good else (rng.choice(words).upper() + "!! ") * size
        docs.append((i, text))
        labels.append((i, int(good), 0))
    return docs, labels


def test_classifier_on_held_out_rows(spark):
    docs, labels = quality_rows()
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_classifier.digests(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    # held-out labels teach nothing
    other = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_classifier.digests(docs, other).collect()}
    assert all(math.isclose(again[r.doc_id], r.score, abs_tol=1e-9) for r in got)


def test_classifier_takes_odd_rows(spark, odd_docs, no_docs):
    docs, labels = quality_rows(200)
    labels = spark.createDataFrame([*labels, (1, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    scores = quality_classifier.digests(odd_docs, labels)
    assert scores.count() == odd_docs.count() and scores.where("score is null or score < 0 or score > 1").count() == 0
    assert quality_classifier.digests(no_docs, labels).count() == 0
    assert {r.score for r in quality_classifier.digests(odd_docs, labels.where("false")).collect()} and quality_classifier.fit(odd_docs, labels.where("false")).levels.tolist() == [0.5, 0.5]
    model = quality_classifier.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    kept = quality_classifier.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns
    scored = {(r.doc_id, round(r.score, 9)) for r in quality_classifier.score(odd_docs, model).where("score >= 0.5").collect()}
    assert Counter(r.doc_id for r in kept.collect()).keys() == {i for i, _ in scored}


def test_isotonic():
    knots, levels = quality_classifier.isotonic([0.0, 1.0, 2.0, 3.0], [1, 1, 1, 1], [0, 1, 0, 1])
    assert levels.tolist() == [0, 0, 0.5, 0.5, 1, 1] and knots.tolist() == [0, 0, 1, 2, 3, 3]


def test_statistics_like_the_plain_ones(odd_rows):
    texts = [t or "" for _, t in odd_rows] + ["a\n\nb\n", "\n", "X1 #x! x, x; aVeryLongWordIndeedHere é", "w w w v w w w"]
    raw = [t.encode() for t in texts]
    got = quality_classifier.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.allclose(got, [brute.statistics(t) for t in texts], atol=1e-9)


def test_fit_like_plain_normal_equations(spark):
    """Weights and calibration by plain least squares over all taught rows at once."""
    rows, labels = quality_rows(400, seed=3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    table = spark.createDataFrame([*labels, (10**9, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, table)
    taught = [k for k, (i, _) in enumerate(rows) if zlib.crc32(str(i).encode()) % 3 != 1]
    x, y = np.array([brute.statistics(rows[k][1]) for k in taught]), np.array([labels[k][1] for k in taught], float)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale <= 1e-9] = 1.0
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)
    rng = np.random.default_rng(quality_classifier.SEED)
    w, b = rng.normal(0, 1 / quality_classifier.WIDTH, (16, quality_classifier.FEATURES)), rng.uniform(0, 2 * np.pi, quality_classifier.FEATURES)
    feature = lambda v: np.array([*(math.sqrt(2 / len(b)) * np.cos(np.clip((v - mean) / scale, -8, 8) @ w + b)), 1.0])
    z = np.array([feature(v) for v in x])
    ridge = lambda own: np.linalg.solve(z[own].T @ z[own] + quality_classifier.RIDGE * own.sum() * np.eye(z.shape[1]), z[own].T @ y[own])
    assert np.allclose(model.weights, ridge(np.ones(len(y), bool)), atol=1e-6)
    fold = np.array([r.f for r in spark.createDataFrame([(rows[k][0],) for k in taught], "doc_id long").select(F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("f")).collect()])
    out = np.where(fold == 0, z @ ridge(fold == 1), z @ ridge(fold == 0))
    low, high, cells = quality_classifier.LOW, quality_classifier.HIGH, quality_classifier.CELLS
    cell = np.clip((out - low) / (high - low) * cells, 0, cells - 1).astype(int)
    used = sorted(set(cell.tolist()))
    levels = brute.isotonic([int((cell == c).sum()) for c in used], [float(y[cell == c].sum()) for c in used])
    at = [low + (c + 0.5) * (high - low) / cells for c in used]
    assert np.allclose(np.interp(at, model.knots, model.levels), levels, atol=1e-9)
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    for i, t in rows[:60]:
        r = feature(np.array(brute.statistics(t))) @ model.weights
        want = (1 - quality_classifier.SLOPE) * np.interp(r, at, levels) + quality_classifier.SLOPE * min(max((r - low) / (high - low), 0), 1)
        assert math.isclose(got[i], want, abs_tol=1e-6)


# ---- 4 substring dedup ----


def test_substring_dedup(odd_docs, odd_rows, no_docs):
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows_of(substring_dedup.digests(odd_docs), *columns) == by_text(brute.substring_dedup(odd_rows))
    assert substring_dedup.digests(no_docs).count() == 0
    kept = {r.doc_id: r.kept for r in substring_dedup.dedup(odd_docs).collect()}
    assert kept[6] == "" and len(kept[5].split()) == 6000


def branching_rows(seed=5):
    """Passages that occur whole, cut off, run together and repeated, behind and before words of their own."""
    rng = random.Random(seed)
    passages = [[f"p{k}x{i}" for i in range(rng.randrange(25, 160))] for k in range(6)]
    rows = []
    for i in range(40):
        words = []
        for _ in range(rng.randrange(1, 4)):
            p = rng.choice(passages)
            a = rng.choice([0, 0, rng.randrange(len(p))])
            words += [f"own{i}y{rng.randrange(9)}" for _ in range(rng.choice([0, 3, 30]))] + p[a : rng.choice([len(p), rng.randrange(len(p)) + 1])]
        rows.append((rng.choice([i, i, None]), " ".join(words)))
    return [*rows, rows[0], rows[1], (90, " ".join(["a", "b", "c"] * 40)), (91, " ".join(["b", "c", "a"] * 30))]


def branching_docs(spark, rows, parts):
    """rows in so many partitions that each is a batch of its own."""
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


@pytest.mark.parametrize("parts", [1, 24])
def test_substring_dedup_of_branching_texts(spark, parts):
    rows = branching_rows()
    got = substring_dedup.digests(branching_docs(spark, rows, parts))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == by_text(brute.substring_dedup(rows))


def test_substring_dedup_removes_by_paths_only(spark, monkeypatch):
    rows = branching_rows()
    monkeypatch.setattr(substring_dedup, "unitigs", lambda said: said.select("v", F.lit(0).alias("length")).distinct())
    assert {r.n_removed for r in substring_dedup.digests(branching_docs(spark, rows, 3)).collect()} == {0}


def test_unitigs(spark):
    rng = random.Random(3)
    chain = list(range(100, 145))  # rounds of doubling
    texts = [chain, [1, *chain, 2], [1, 3, 4, 1, 3, 4, 1, 3], [5, 6, 7], [5, 6, 8], [5, 6], [9, 9, 9], [-4, -3], [-4, -3, 11]]
    texts += [[rng.randrange(20, 30) for _ in range(rng.randrange(1, 6))] for _ in range(8)]
    n = {v: rng.randrange(1, 14) for t in texts for v in t}
    said, after, before = [], {}, {}
    for bucket, t in enumerate(texts):
        for v, prior, follow in zip(t, [0, *t], [*t[1:], 0]):
            said.append((bucket, v, n[v], n[v] + (v == 120), follow, follow, prior, prior))  # 120 is of two lengths: hashes collided
            after.setdefault(v, set()).add(follow)
            before.setdefault(v, set()).add(prior)
    to = {v: next(iter(f)) for v, f in after.items() if len(f) == 1 and v != 120}
    to = {v: w for v, w in to.items() if w not in (0, 120) and before[w] == {v}}
    want = {w: 0 for w in to.values()}
    for v in to.keys() - want.keys():
        want[v], at = n[v], v
        while at in to:
            at = to[at]
            want[v] += n[at]
    fields = "bucket long, v long, n_least int, n_most int, after_least long, after_most long, before_least long, before_most long"
    got = {r.v: r.length for r in substring_dedup.unitigs(spark.createDataFrame(said, fields)).collect()}
    assert got == want and got[100] == sum(n[v] for v in range(100, 120)) and got[121] > 0
    assert substring_dedup.unitigs(spark.createDataFrame([], fields)).count() == 0


def test_substring_paths_are_verified(spark):
    """A path with a word that differs from its source's, as if hashes had collided, loses only the edges over that word."""
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:30], "other", *words[31:]])), (3, " ".join(words))], "doc_id long, text string")
    texts = docs.select(*substring_dedup.row_key(docs, "doc_id", "text"))
    key = {r["__id"]: (r["__id"], r["__tag"], r["__top"]) for r in texts.collect()}
    copies = [(*key[2], 0, 60, *key[1], 0), (*key[3], 0, 60, *key[1], 0)]
    found = spark.createDataFrame(copies, "id long, tag long, top int, lo int, n int, sid long, stag long, stop int, slo int")
    merged = substring_dedup.spans.from_rows(substring_dedup.verified(texts, found)).collect()
    assert {r["__id"]: np.frombuffer(r["__spans"], "<i4").tolist() for r in merged} == {2: [0, 30, 31, 60], 3: [0, 60]}


# ---- 5 line dedup ----


def spec_lines(rows, ratio, least):
    total = Counter(s for _, s, _ in rows)
    pages = Counter((s, x) for _, s, t in rows for x in set((t or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r"))
    out = []
    for i, s, t in rows:
        if t is not None:
            t = "\n".join(x for x in t.split("\n") if not (pages[s, x] >= least and pages[s, x] > ratio * total[s]))
        out.append((i, t))
    return out


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_line_dedup(spark, limit):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", None]), "\n".join([rng.choice(["head", "", "x y", " "]), f"own {i}", rng.choice(["foot", f"f{i}"])])) for i in range(80)] + [(90, "a", None), (91, "a", ""), (92, "c", "head"), (92, "c", "head")]
    docs = spark.createDataFrame(rows, "doc_id int, source string, text string").withColumn("__lines", F.lit(0)).withColumn("pages", F.lit(1)).drop("__lines")
    got = line_dedup.drop_lines(docs, ratio=0.2, min_pages=3, limit=limit)
    assert rows_of(got, "doc_id", "text") == by_text(spec_lines(rows, 0.2, 3))
    assert set(got.columns) == {*docs.columns, "__dropped"}
    assert line_dedup.drop_lines(docs.where("false")).count() == 0


# ---- 6 quality rules ----


def spark_xxhash(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else int(v).to_bytes(8, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def spec_buckets(text, buckets):
    h = [spark_xxhash([w.lower().encode()]) for w in brute.WORD.findall(text)]
    return [x % buckets for x in h] + [spark_xxhash(p) % buckets for p in zip(h, h[1:])]


def test_quality_rules(spark, odd_docs, odd_rows, no_docs):
    extra, labels = quality_rows(60, 5)
    rows = [*odd_rows, *((1000 + i, t) for i, t in extra)]
    trusted_ids = {1000 + i for i, q, _ in labels if q} | {5}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).repartition(3)
    trusted = spark.createDataFrame([(i,) for i in trusted_ids] + [(5,), (None,)], "id long")
    raw, good = Counter(), Counter()
    buckets = quality_rules.bucket_count(sum(len((t or "").encode()) for _, t in rows))
    for i, t in rows:
        b = spec_buckets(t or "", buckets)
        raw.update(b)
        good.update(b if i in trusted_ids else [])
    a, n, m = quality_rules.SMOOTHING, sum(raw.values()), sum(good.values())
    ratio = lambda b: math.log((good[b] + a) / (raw[b] * m / n + a))
    want = []
    for i, t in rows:
        b = spec_buckets(t or "", buckets)
        s = sum(map(ratio, b)) / len(b) if b else 0.0
        base = brute.base_rules(t)
        want.append((i, *base, not base[-1] and s >= quality_rules.THRESHOLD))
    got = quality_rules.judge(docs, trusted)
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept") == by_text(want)
    junk = {1000 + i for i, q, _ in labels if not q}
    assert not any(r.kept for r in got.collect() if r.doc_id in junk)
    assert quality_rules.judge(no_docs, trusted).count() == 0
    assert {r.score for r in quality_rules.judge(odd_docs, trusted.where("false")).collect()} == {0.0}


def test_words_decide_and_not_their_shapes(spark):
    """Lower-case spam has the shapes of prose; its words tell."""
    rng = random.Random(12)
    prose, spam = [f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)], [f"q{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    rows = [(i, " ".join(rng.choice(prose if i % 3 else spam) for _ in range(60))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 300, 2) if i % 3], "id long")
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, trusted).collect()}
    assert all(got[i] == (i % 3 > 0) for i in range(300))
    assert quality_rules.bucket_count(1 << 20) < quality_rules.bucket_count(1 << 30) < quality_rules.bucket_count(1 << 40)


def test_repeated_windows_and_lines(spark):
    texts = ["a b c d e f a b c d e g", "\n\nx\n x\nx\n\n", "a a a a a a a", "# * < é€ |", "a b c d e " * 3]
    got = {r.text: r for r in quality_rules.base_rules(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    for t in texts:
        r = got[t]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(t)


# ---- 7 Jaccard join ----


def near_copies(n=60, words=120, seed=5):
    rng = random.Random(seed)
    base = [f"x{rng.randrange(50)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(words)] = f"y{rng.randrange(1000)}"
        out.append((500 + i, " ".join(w)))
    return out


def test_jaccard(spark, odd_docs, odd_rows, no_docs):
    rows = [*odd_rows, *near_copies(), (700, "B A " * 90), (701, "b a " * 90), (702, "b a\tb a\nb"), (703, "p q"), (704, "P Q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("k")).repartition(6)
    assert rows_of(jaccard_join.assign(docs), "doc_id", "n_shingles", "component_id") == by_text(brute.jaccard(rows))
    assert jaccard_join.assign(no_docs).count() == 0
    distinct = [r for r in rows if r[0] is not None and r != (8, dict(odd_rows)[8])]
    docs = spark.createDataFrame(distinct, "doc_id long, text string").withColumn("key", F.lit("k")).repartition(6)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in brute.jaccard(distinct) if i == c)


def test_keep_one_drops_repeated_and_null_id_rows(spark):
    near, shared = near_copies(12), " ".join(f"s{i}" for i in range(30))
    wordless = [(1, None), (1, None), (2, ""), (2, ""), (None, " \n"), (None, " \n")]
    rows = [*near, *near, (7, shared), (None, shared), (None, shared), (None, shared), (None, "p q"), (None, "p q"), *wordless]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a.b", F.lit("k")).repartition(4)
    kept = jaccard_join.keep_one(docs)
    want = [r for r, (i, _, c) in zip(near, brute.jaccard(near)) if i == c] + [(None, shared), (None, "p q"), *wordless]
    assert kept.columns == docs.columns and sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(str, want))


def test_jaccard_without_stars(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "STARS", 0)
    monkeypatch.setattr(jaccard_join.blobs, "GATHER", 50)
    rows = near_copies(25)
    assert rows_of(jaccard_join.assign(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id") == by_text(brute.jaccard(rows))


def test_common_shingles_are_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    rows = near_copies(40, seed=6) + near_copies(20, 60, seed=7)
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(0, rows[0][1])]
    got = rows_of(jaccard_join.assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), "doc_id", "n_shingles", "component_id")
    assert got == by_text(brute.jaccard(rows))


def test_each_pair_is_verified_once(spark, monkeypatch):
    seen = []
    plain = jaccard_join.linked
    monkeypatch.setattr(jaccard_join, "linked", lambda pairs, sets: (seen.extend((r.u, r.v) for r in pairs.collect()), plain(pairs, sets))[1])
    rng = random.Random(13)
    base = [[f"x{rng.randrange(50)}" for _ in range(90)] for _ in range(3)]
    rows = []
    for i in range(60):
        w = list(base[i % 3])
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(90)] = f"y{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    got = rows_of(jaccard_join.assign(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == by_text(brute.jaccard(rows)) and len(seen) == len(set(seen)) > 0


def test_suffix_bound_is_a_bound():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(2))
        assert jaccard_join.suffix_bound(x, y) >= len(np.intersect1d(x, y))


@pytest.mark.parametrize("small", [0, 1000])
def test_components(spark, small):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 150), (150, 300)] + [(400 + rng.randrange(60), 400 + rng.randrange(60)) for _ in range(45)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long"), small).collect()}
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {x: root(x) for x in linked}


# ---- 8 suffix dedup ----


def test_suffix_dedup(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefgh") for _ in range(900))
    more = [(800 + i, base[rng.randrange(300) : rng.randrange(500, 900)] + base[rng.randrange(300) : rng.randrange(400, 900)]) for i in range(15)]
    rows = [*odd_rows, *more]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lo", F.lit("x")).repartition(6)
    assert rows_of(suffix_dedup.digests(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == by_text(brute.suffix_dedup(rows))
    assert suffix_dedup.digests(no_docs).count() == 0


def chopped(n=12, seed=8, letters="abcd"):
    rng = random.Random(seed)
    base = "".join(rng.choice(letters) for _ in range(1200))
    return [(i, base[rng.randrange(600) : rng.randrange(600, 1200)]) for i in range(n)]


SPANNED = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_dedup_over_batches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TEXT_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 900)
    monkeypatch.setattr(suffix_dedup.blobs, "GATHER", 3)
    rows = chopped()
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert rows_of(got, *SPANNED) == by_text(brute.suffix_dedup(rows))


@pytest.mark.parametrize("hot", [0, 1, 4])
def test_common_anchors_are_split(spark, monkeypatch, hot):
    """Strings of 50 to 198 bytes in many contexts, some of whose windows recur."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "TEXT_BYTES", 2000)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    common = [noise(n) for n in (50, 120, 165, 182, 191, 196, 198, 199, 200)]
    rows = [(i, noise(rng.randrange(150)) + common[i % 9] + noise(rng.randrange(150))) for i in range(80)]
    rows += [(100 + i, rows[7 * i][1][rng.randrange(30) :] + noise(9)) for i in range(10)]
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert rows_of(got, *SPANNED) == by_text(brute.suffix_dedup(rows))


def test_every_removal_comes_from_the_sort(monkeypatch):
    raw = np.frombuffer(b"ab" * 400, np.uint8)
    run = lambda: suffix_dedup.shared_windows(np.array([1, 1], np.uint64), np.array([0, 400]), np.array([10, 10]), np.array([5, 5]), raw, 200)
    assert run()[0].all()
    monkeypatch.setattr(suffix_dedup.Suffixes, "neighbours", lambda self, order, group: (np.zeros(len(group), np.int64), False))
    whole, _, number, at = run()
    assert not whole.any() and not len(number) and not len(at)


def test_suffix_sort_survives_hash_collisions(monkeypatch):
    """Two bytes with one hash value: lengths are those of the bytes."""
    values = suffix_dedup.byte_values(np.arange(256, dtype=np.uint8))
    values[ord("b")] = values[ord("a")]
    monkeypatch.setattr(suffix_dedup, "byte_values", lambda raw: values[raw])
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    raw, size = np.frombuffer("".join(pieces).encode(), np.uint8), np.array([len(p) for p in pieces])
    s = suffix_dedup.Suffixes(raw, np.cumsum(size) - size, size)
    order, near = s.ordered(np.zeros(len(pieces), np.int64))
    assert [pieces[k] for k in order] == sorted(pieces)
    for k in range(1, len(order)):
        a, b = pieces[order[k - 1]], pieces[order[k]]
        assert near[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.text("ab", max_size=12), min_size=1, max_size=20), st.integers(1, 3))
def test_suffix_sort(pieces, groups):
    raw = np.frombuffer("".join(pieces).encode() or b"a", np.uint8)
    size = np.array([len(p) for p in pieces])
    s = suffix_dedup.Suffixes(raw, np.cumsum(size) - size, size)
    group = np.sort(np.arange(len(pieces)) % groups)
    order = s.sort(group)
    want = sorted(range(len(pieces)), key=lambda k: (group[k], pieces[k], k))
    assert order.tolist() == want
    near, collided = s.neighbours(order, group)
    assert not collided
    for k in range(1, len(order)):
        a, b = pieces[order[k - 1]], pieces[order[k]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert near[k] == (same if group[k] == group[k - 1] else 0)


# ---- 9 url filters ----


def test_url_parts_and_rules(spark):
    urls = [
        ("http://A.Example.NET/en/1?x=/y#z", "a.example.net", "/en/1", "example.net/en/", "allow"), ("https://example.net", "example.net", "", None, "allow"), ("https://example.net/fr/", "example.net", "/fr/", "net/", "block"),
        ("x://b.example.com/de/9://c", "b.example.com", "/de/9://c", "example.com/de/", "block"), ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"), ("ftp://q.org/fr/?a", "q.org", "/fr/", "org/fr/", "allow"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("http://É.org#/p", "É.org", "", None, "allow"), ("://h\n/p\nq", "h\n", "/p\nq", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("html", F.lit(None).cast("string"))
    none = spark.createDataFrame([], "url string, good boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages, none).collect()}
    assert got == {i: u[1:] for i, u in enumerate(urls)}
    assert url_filters.judge(pages.where("false"), none).count() == 0


def test_bad_branches_are_rejected(spark):
    pages, labels = [], []
    for i in range(200):
        bad = i % 2 == 0
        url = f"http://h.org/{'spam' if bad else 'news'}/{i}.html"
        pages.append((i, url))
        labels.append((url, not bad))
    pages += [(1000 + i, f"http://h.org/spam/{9000 + i}.html") for i in range(5)] + [(2000, "http://other.org/spam/1.html"), (2001, None)]
    got = {r.page_id: r.verdict for r in url_filters.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "url string, good boolean")).collect()}
    assert all(got[i] == ("block" if i % 2 == 0 else "allow") for i in range(200)) and all(got[1000 + i] == "block" for i in range(5))
    assert got[2000] == got[2001] == "allow"


def test_many_children_become_a_wildcard(spark):
    pages = spark.createDataFrame([(f"http://h.org/u/name-{i}/home",) for i in range(60)] + [("http://h.org/about/x",)] * 50, "url string")
    got = {r.form: r.template for r in url_filters.templates(pages).collect()}
    assert {got[f"u/name-{i}/home"] for i in range(60)} == {"u/*/home"} and got["about/x"] == "about/x"


def test_wildcards_below_wildcards(spark):
    urls = [f"http://h.org/u/user-{i}x/post-{chr(97 + i % 26)}{i}z" for i in range(60)] + ["http://h.org/u/user-1x/post-b1z/more"] * 2
    got = {r.form: r.template for r in url_filters.templates(spark.createDataFrame([(u,) for u in urls], "url string")).collect()}
    assert set(got.values()) == {"u/*/*", "u/*/*/more"}


def test_a_label_below_a_wildcard_does_not_escape(spark):
    urls = [f"http://h.org/u/user-{i}x/p/post-{i}z" for i in range(60)]
    other = [f"http://h.org/news/{i}" for i in range(60)]
    labels = [(u, k == 0) for k, u in enumerate(urls[:40])] + [(u, True) for u in other]
    pages = spark.createDataFrame(list(enumerate(urls + other)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filters.judge(pages, spark.createDataFrame(labels, "url string, good boolean")).collect()}
    assert all(got[k] == ("block" if k < 60 else "allow") for k in range(120))


def test_similar_siblings_are_judged_together(spark):
    """Four branches of four bad labels each: alone each is too small to be rejected."""
    bad = [f"http://h.org/{d}/{i}" for d in ("spam", "junk", "ads", "casino") for i in range(4)]
    good = [f"http://h.org/{d}/{i}" for d in ("news", "blog") for i in range(60)]
    rows = bad + good
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    labels = spark.createDataFrame([(u, u in good) for u in rows], "url string, good boolean")
    got = {r.page_id: r.verdict for r in url_filters.judge(pages, labels).collect()}
    assert all(got[k] == ("block" if k < 16 else "allow") for k in range(len(rows)))
    one = url_filters.judge(pages.where("page_id < 4 or page_id >= 16"), labels.where("url like '%spam%' or good")).where("page_id < 4").collect()
    assert {r.verdict for r in one} == {"allow"}


def test_urls_that_are_long_repeated_or_null(spark):
    deep = "http://h.org/" + "/".join(f"a{i % 7}" for i in range(200_000))
    urls = [deep, deep, deep + "/x", None, None, "", "http://h.org//", "HTTP://H.org/a0/", "http://h.org/" + "b" * 1_000_000]
    pages = spark.createDataFrame([(i % 6, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns({c: F.lit("mine") for c in ("host", "form", "template", "any", "s", "rule")})
    labels = spark.createDataFrame([(deep, False), (deep, True), (None, True)], "url string, good boolean")
    got = url_filters.judge(pages, labels).collect()
    assert len(got) == len(urls) and {len(r.path) for r in got if r.path.startswith("/a0/a1")} == {len(deep) - 12, len(deep) - 10}
    assert all(r.verdict == "allow" for r in got)


# ---- 10 token shards ----


@pytest.mark.parametrize("total", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(total):
    slots = token_shards.permute(np.arange(total), total, 5)
    assert sorted(slots.tolist()) == list(range(total))
    if total > 60:
        assert slots.tolist() != token_shards.permute(np.arange(total), total, 6).tolist() != list(range(total))


def test_shards_hold_every_sequence(spark, odd_docs, odd_rows, no_docs, tmp_path):
    folder = f"file://{tmp_path}/shards"
    got = {r.shard: r for r in token_shards.write(odd_docs, PATH, folder, length=16, shard=100).collect()}
    coder = bpe.load(PATH)
    want = []
    distinct = {(i, t or "") for i, t in odd_rows}
    hashed = {r.text: (r.a, r.b) for r in spark.createDataFrame(sorted({(t,) for _, t in distinct}), "text string").select("text", F.xxhash64("text").alias("a"), F.hash("text").alias("b")).collect()}
    for i, t in sorted(distinct, key=lambda r: (brute.order(r[0]), hashed[r[1]])):
        ids = np.frombuffer(coder.encode(t or ""), "<u4").tolist() + [token_shards.END]
        ids += [token_shards.END] * (-len(ids) % 16)
        want += [tuple(ids[k : k + 16]) for k in range(0, len(ids), 16)]
    total = sum(r.n_sequences for r in got.values())
    read = [tuple(x.tolist()) for x in token_shards.read(folder, 0, 10**9, 16, 100)]
    slots = token_shards.permute(np.arange(total), total).tolist()
    assert len(read) == total == len(want) and [read[s] for s in slots] == want
    for k, r in got.items():
        data = (tmp_path / "shards" / token_shards.shard_name(k)).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest(), r.first_slot) == (r.n_bytes, r.sha256, k * 100) and r.n_bytes == r.n_sequences * 32
    assert [tuple(x.tolist()) for x in token_shards.read(folder, 150, 30, 16, 100)] == read[150:180]
    again = {r.shard: r.sha256 for r in token_shards.write(odd_docs.repartition(2), PATH, f"file://{tmp_path}/again", length=16, shard=100).collect()}
    assert again == {k: r.sha256 for k, r in got.items()}
    assert token_shards.write(no_docs, PATH, f"file://{tmp_path}/none").count() == 0
