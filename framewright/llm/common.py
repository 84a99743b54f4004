"""What the operators share: input columns, lineage cuts, text batches, size-checked joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.sources.shared import cut, remove, shared_dir  # noqa: F401 (the operators take them from here)

#: Largest estimated size of a join side that is broadcast; beyond it the join shuffles.
BROADCAST_LIMIT = 32 << 20
#: Id that stands for a null doc_id inside the operators: before all others.
NULL_ID = -(1 << 63)
#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Text bytes that a Python worker turns into arrays at a time (a longer text is one chunk).
CHUNK_BYTES = 1 << 19


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow with batches of BATCH_ROWS: texts are large rows, and the default of 10,000 would hold tens of MB in every worker and beside every executor's heap. A session setting other than Spark's default is left alone."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH) == "10000":
        conf.set(_BATCH, str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def ascii_lower(text: Column) -> Column:
    """text with A-Z, and nothing else, in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: What tells documents apart inside the operators: the id and 96 bits of the text's hashes, as null ids are all one id.
KEY = ["__id", "__tag", "__top"]
KEY_SCHEMA = "__id long, __tag long, __top int"


def row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """KEY (null ids first; rows that share an id but not a text stay apart by their text's two hashes) and __text (null: empty)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return [
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("__id"),
        F.xxhash64(text).alias("__tag"),
        F.hash(text).alias("__top"),
        text.alias("__text"),
    ]


def join_checked(left: DataFrame, right: DataFrame, on: list[str], row_bytes: Column, how: str = "left", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """left join right, where right has been cut: broadcast only if its summed row_bytes stay under the limit, else shuffled with skew splitting."""
    size = right.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0
    return left.join(F.broadcast(right) if size <= limit else right, on, how)


def total_bytes(docs: DataFrame, text_col: str) -> int:
    """UTF-8 bytes of all texts; it sizes bucket counts."""
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("long"))).first()[0] or 0


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and its len + 1 offsets into them."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text_col: str = "__text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of at most `most` text bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffers(batch.column(text_col))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def keys(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The KEY columns of a batch as the fields of a packed record."""
    return {"id": ints(batch.column("__id")), "tag": ints(batch.column("__tag")), "top": ints(batch.column("__top"), np.int32)}


def ints(column: pa.Array, kind=np.int64) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(kind, copy=False)
