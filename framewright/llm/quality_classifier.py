"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

Every whole text becomes a short vector of statistics; the cosine features of a fixed
random projection approximate a Gaussian kernel over them. Each partition sums its part
of the normal equations, the sums are added up row by row in a shuffle, and only the
(features + 1) squared result reaches the driver, whatever the input's size. Two folds
are fitted crosswise; their out-of-fold scores, summed on a fixed grid, give the
isotonic map from scores to probabilities.

Defined results: a null text is an empty one, and empty texts are scored like others;
documents labelled more than once take the least label; labels without a document and
documents without a label only do not teach; without any label every score is 0.5;
repeated rows get equal scores; ids, languages, sources and labels are never inputs of
a score; other columns pass through `keep_good` unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from framewright.llm.common import chunks, cut, map_arrow, text_buffers
from framewright.llm.hashing import Prefixes, Words, byte_values

#: Cosine features, the kernel's width over standardised statistics, and the ridge term for each labelled row.
FEATURES, WIDTH, RIDGE, SEED = 256, 2.5, 1e-3, 97
#: Cells of the grid on which out-of-fold scores are summed, and its range.
CELLS, LOW, HIGH = 2048, -1.0, 2.0
#: Share of the raw score that keeps calibrated scores apart within a step.
SLOPE = 1e-3

STATISTICS = (
    "log_words", "word_bytes", "upper", "digits", "symbols", "marks", "stops", "lines", "beyond_ascii",
    "distinct_words", "top_word", "twins", "repeated_windows", "repeated_lines", "line_words", "long_words",
)

_CLASS = np.zeros((256, 6), np.uint8)
for _k, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>@^~_=+{}[]\\/", b"!?", b".,;:", b"")):
    _CLASS[list(_set), _k] = 1
_CLASS[128:, 5] = 1


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text of a batch."""
    docs = len(offsets) - 1
    size = np.diff(offsets)
    words = Words(raw, offsets)
    count = np.diff(words.first)
    hashes = words.hashes()
    own = np.repeat(np.arange(docs), count)
    length = words.ends - words.starts
    solid = np.bincount(own, length, docs)

    def share(a, b):
        return a / np.maximum(b, 1)

    def total(mask):
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def runs(values, of):
        """distinct values and the largest count of each document"""
        order = np.lexsort((values, of))
        v, d = values[order], of[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
        cuts = np.flatnonzero(new)
        n = np.diff(np.append(cuts, len(v)))
        most = np.zeros(docs)
        np.maximum.at(most, d[cuts], n)
        return np.bincount(d[cuts], minlength=docs), most

    classes = [total(_CLASS[raw, k]) for k in range(6)]
    distinct, most = runs(hashes, own)
    twin = np.zeros(len(hashes), bool)
    twin[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    grams = Prefixes(hashes).grams(3)
    inner = own[: len(grams)] == own[2:][: len(grams)]
    windows, _ = runs(grams[inner], own[: len(grams)][inner])
    n_windows = np.bincount(own[: len(grams)][inner], minlength=docs)
    # lines: between line ends and text edges
    breaks = np.flatnonzero(raw == 10)
    edges = np.unique(np.concatenate((offsets, breaks + 1)))
    start, end = edges[:-1], edges[1:]
    line_doc = np.searchsorted(offsets, start, "right") - 1
    line_hash = Prefixes(byte_values(raw), 1).ranges(start, end)
    # a line's hash counts with its line end, if it has one
    ended = raw[end - 1] == 10 if len(raw) else np.empty(0, bool)
    line_hash = Prefixes(byte_values(raw), 1).ranges(start, end - ended)
    lines = np.bincount(line_doc, minlength=docs)
    distinct_lines, _ = runs(line_hash, line_doc)
    letters = np.maximum(solid, 1)
    return np.column_stack((
        np.log1p(count), share(solid, count), classes[0] / letters, classes[1] / letters, classes[2] / letters, classes[3] / letters, classes[4] / np.maximum(count, 1),
        share(lines, count), classes[5] / letters, share(distinct, np.sqrt(np.maximum(count, 1))), share(most, count), share(np.bincount(own, twin, docs), count),
        1 - share(windows, n_windows) * (n_windows > 0) - (n_windows == 0), 1 - share(distinct_lines, lines), np.log1p(share(count, lines)), share(np.bincount(own, length > 15, docs), count),
    )) * (size > 0)[:, None]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return features(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        r = self.raw(x)
        return (1 - SLOPE) * np.interp(r, self.knots, self.levels) + SLOPE * np.clip((r - LOW) / (HIGH - LOW), 0, 1)


def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, 1 / WIDTH, (x.shape[1], FEATURES))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -8, 8)
    return np.column_stack((np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones(len(x))))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(STATISTICS)) if len(column) else np.empty((0, len(STATISTICS)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, x (its statistics), one narrow pass."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x = statistics(*text_buffers(batch.column("__text")))
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), lists], names=["doc", "x"])

    return map_arrow(rows, run, f"doc {rows.schema['doc'].dataType.simpleString()}, x array<double>")


def held_out(id_col: Column) -> Column:
    """Rows that must not teach: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from all labelled rows that are not held out. labels: id, quality."""
    d = len(STATISTICS)
    taught = labels.select(F.col(id_col).alias("doc"), F.col("quality").cast("int").alias("y")).where(F.col("doc").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc")))
    taught = taught.groupBy("doc").agg(F.min("y").alias("y"))
    rows = measured(docs.where(F.col(f"`{id_col}`").isNotNull()), id_col, text_col).join(taught, "doc")
    rows = cut(rows.select("x", F.col("y").cast("double").alias("y"), F.pmod(F.xxhash64("doc"), F.lit(2)).cast("int").alias("fold")))
    moments = rows.agg(F.count("*"), *(f(F.col("x")[k]) for k in range(d) for f in (F.avg, F.stddev_pop))).first()
    if not moments[0]:
        return Model(np.zeros(d), np.ones(d), np.zeros(FEATURES + 1), np.array([LOW, HIGH]), np.array([0.5, 0.5]))
    mean, scale = np.array(moments[1::2]), np.array(moments[2::2])
    scale = np.where(scale > 1e-9, scale, 1.0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((2, FEATURES + 1, FEATURES + 3))
        for whole in batches:
            for batch in (whole.slice(k, 4096) for k in range(0, whole.num_rows, 4096)):
                z = features(_matrix(batch.column("x")), mean, scale)
                y, fold = batch.column("y").to_numpy(), batch.column("fold").to_numpy()
                for k in (0, 1):
                    own = z[fold == k]
                    a[k, :, :-2] += own.T @ own
                    a[k, :, -2] += own.T @ y[fold == k]
                    a[k, :, -1] += len(own)
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(a[k])), pa.array(range(len(a[k]))), pa.array([r.tobytes() for r in a[k]], pa.binary())], names=["fold", "i", "part"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = np.sort(np.stack([np.frombuffer(p) for p in pdf["part"]]), axis=0)  # sorted, so the sum is the same in any order
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "i": pdf["i"].iloc[:1], "part": [parts.sum(axis=0).tobytes()]})

    schema = "fold long, i long, part binary"
    total = np.zeros((2, FEATURES + 1, FEATURES + 3))
    for row in map_arrow(rows, sums, schema).groupBy("fold", "i").applyInPandas(add, schema).collect():
        total[row["fold"], row["i"]] = np.frombuffer(row["part"])

    def solve(a: np.ndarray) -> np.ndarray:
        n = max(a[0, -1], 1.0)
        return np.linalg.solve(a[:, :-2] + RIDGE * n * np.eye(FEATURES + 1), a[:, -2])

    crossed = np.stack((solve(total[1]), solve(total[0])))

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, good = np.zeros(CELLS), np.zeros(CELLS)
        for whole in batches:
            for batch in (whole.slice(k, 4096) for k in range(0, whole.num_rows, 4096)):
                z = features(_matrix(batch.column("x")), mean, scale)
                r = (z * crossed[batch.column("fold").to_numpy()]).sum(axis=1)
                cell = np.clip((r - LOW) / (HIGH - LOW) * CELLS, 0, CELLS - 1).astype(int)
                n += np.bincount(cell, minlength=CELLS)
                good += np.bincount(cell, batch.column("y").to_numpy(), CELLS)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(good[used])], names=["cell", "n", "good"])

    cells = map_arrow(rows, grid, "cell long, n double, good double").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).orderBy("cell").collect()
    knots, levels = isotonic([LOW + (c["cell"] + 0.5) * (HIGH - LOW) / CELLS for c in cells], [c["n"] for c in cells], [c["good"] for c in cells])
    return Model(mean, scale, solve(total[0] + total[1]), knots, levels)


def isotonic(at: list[float], n: list[float], good: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the nondecreasing step function nearest to good / n, as the first and last place of each step and its level."""
    blocks: list[list[float]] = []
    for x, w, g in zip(at, n, good):
        blocks.append([x, x, w, g])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1][1:] = [last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    return np.array([x for b in blocks for x in b[:2]]), np.array([b[3] / b[2] for b in blocks for _ in (0, 1)])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score of every document: one narrow pass."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            s = model.score(statistics(*text_buffers(batch.column("__text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(s)], names=["doc", "score"])

    return map_arrow(rows, run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double").withColumnRenamed("doc", id_col)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that score at least `least`, with all their columns; decided in place, without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(statistics(*text_buffers(c.column("__text")))) >= least for c in chunks(iter([batch]))]
            mask = pa.array(np.concatenate(keep) if keep else [], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("__row").filter(mask)], names=["__row"])

    # the row stands apart from the text, so none of its columns' names can be in the way
    rows = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    return map_arrow(rows, run, StructType([rows.schema["__row"]])).select("__row.*")


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
