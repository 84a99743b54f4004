"""Spans of documents found by many reducers, brought together and applied to the texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import blobs
from framewright.llm.blobs import Columns
from framewright.llm.common import KEY, KEY_SCHEMA, join_checked, map_arrow, row_key

#: A span of a document: its owner, first place and length.
SPAN = blobs.OWNER | {"lo": "<i4", "n": "<i4"}


def bucket_of(columns: Columns, buckets: int) -> np.ndarray:
    """The bucket of a document's spans; null ids, which are all one id, are dealt by their texts' hash."""
    mixed = columns["id"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ columns["tag"].view(np.uint64)
    return (mixed >> np.uint64(20)).astype(np.int64) % buckets


def spread(columns: Columns, buckets: int, fields: dict[str, str] = SPAN) -> tuple[list[int], list[bytes]]:
    """Spans packed by their document's bucket."""
    order = np.lexsort((columns["lo"], columns["tag"], columns["id"]))
    own = blobs.take(columns, order)
    return blobs.scatter(own, bucket_of(own, buckets), fields)


def by_document(packed: DataFrame) -> DataFrame:
    """One row per document that has spans: KEY, __spans (disjoint sorted [start, end) pairs, packed 32-bit). A document's spans are bounded by its own length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], SPAN)
        order, group = blobs.groups(*blobs.owner(c))
        c = blobs.take(c, order)
        cut = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
        spans = [blobs.merged(c["lo"][a:b], c["lo"][a:b] + c["n"][a:b]).astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]
        return pd.DataFrame({f"__{k}": c[k][cut[:-1]] for k in blobs.OWNER} | {"__spans": spans})

    return packed.groupBy("bucket").applyInPandas(run, f"{KEY_SCHEMA}, __spans binary")


def from_rows(rows: DataFrame) -> DataFrame:
    """Like by_document, of rows KEY, lo, n."""
    lists = rows.groupBy(*KEY).agg(F.collect_list("lo").alias("lo"), F.collect_list("n").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for lo, n in zip(batch.column("lo"), batch.column("n")):
                lo, n = (x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lo, n))
                packed.append(blobs.merged(lo, lo + n).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([*map(batch.column, KEY), pa.array(packed, pa.binary())], names=[*KEY, "__spans"])

    return map_arrow(lists, run, f"{KEY_SCHEMA}, __spans binary")


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, __text and __spans of every row; spans must be cut. They are broadcast only under the size limit, else both sides shuffle by document."""
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), *row_key(docs, id_col, text_col))
    return join_checked(texts, spans, KEY, F.length("__spans") + 40).select("doc", "__text", "__spans")


def apply_spans(rows: DataFrame, each: Callable[[bytes, np.ndarray], tuple], fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
    """each(text in UTF-8, flat spans) for every row of with_spans, a narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            texts = batch.column("__text").cast(pa.large_binary()).to_pylist()
            spans = batch.column("__spans").to_pylist()
            out = [each(t, np.frombuffer(s, "<i4").astype(np.int64) if s else none) for t, s in zip(texts, spans)]
            columns = zip(*out) if out else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *(pa.array(list(c), kind) for c, (_, kind) in zip(columns, fields))], names=["doc", *(k for k, _ in fields)])

    return map_arrow(rows, run, f"doc {rows.schema['doc'].dataType.simpleString()}, {schema}")
