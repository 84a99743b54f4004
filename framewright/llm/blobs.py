"""Records of repeated pieces, packed by bucket before they are shuffled.

A mapper packs thousands of records a bucket into one binary row (columns, deltas,
byte planes, zstd), so a shuffle carries few small rows. What a batch can decide by
itself (pieces that recur within it) it decides; per key at most one record a batch
is sent on, so a hot key costs a record a batch and not a record a row.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard

#: Records that a mapper gathers before it combines and packs them.
GATHER = 300_000
#: Input text bytes for each bucket of a shuffle, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 64

#: The fields of a record that name its document: see common.KEY.
OWNER = {"id": "<i8", "tag": "<i8", "top": "<i4"}

Columns = dict[str, np.ndarray]


def buckets_for(text_bytes: int) -> int:
    return max(LEAST_BUCKETS, text_bytes // BUCKET_BYTES)


def pack(columns: Columns, fields: dict[str, str]) -> bytes:
    """Columns of one length as bytes; names starting with = are stored as they are, others as differences."""
    planes = []
    for name, kind in fields.items():
        column = np.ascontiguousarray(columns[name.lstrip("=")], kind)
        if name[0] != "=":
            column = np.diff(column, prepend=column.dtype.type(0))
        planes.append(column.view(np.uint8).reshape(len(column), -1).T.tobytes())
    size = len(columns[next(iter(fields)).lstrip("=")])
    return size.to_bytes(4, "little") + zstandard.compress(b"".join(planes), 1)


def unpack(blobs: Iterable[bytes], fields: dict[str, str]) -> Columns:
    """The columns of several blobs, one after another."""
    parts: dict[str, list[np.ndarray]] = {name: [] for name in fields}
    for blob in blobs:
        n, data, at = int.from_bytes(blob[:4], "little"), zstandard.decompress(blob[4:]), 0
        for name, kind in fields.items():
            width = np.dtype(kind).itemsize
            column = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T.copy().view(kind).ravel()
            at += n * width
            parts[name].append(column if name[0] == "=" else np.cumsum(column, dtype=kind))
    return {name.lstrip("="): np.concatenate(p) if p else np.empty(0, kind) for (name, kind), p in zip(fields.items(), parts.values())}


def scatter(columns: Columns, bucket: np.ndarray, fields: dict[str, str]) -> tuple[list[int], list[bytes]]:
    """Bucket numbers and the packed records of each."""
    order = np.argsort(bucket, kind="stable")
    sorted_buckets = bucket[order]
    cut = np.flatnonzero(np.diff(sorted_buckets, prepend=-1)) if len(order) else np.empty(0, np.int64)
    ends = [*cut[1:], len(order)]
    own = {name: column[order] for name, column in columns.items()}
    return [int(sorted_buckets[a]) for a in cut], [pack({name: c[a:b] for name, c in own.items()}, fields) for a, b in zip(cut, ends)]


def batch_of(numbers: list[int], packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(packed, pa.binary())], names=["bucket", "blob"])


def concat(parts: list[Columns]) -> Columns:
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def take(columns: Columns, which: np.ndarray) -> Columns:
    return {name: c[which] for name, c in columns.items()}


def owner(columns: Columns) -> tuple[np.ndarray, ...]:
    """The arrays that name each record's document, as keys for `groups`."""
    return columns["id"], columns["tag"], columns["top"]


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys stand together (earlier keys first, ties stable), and the group number of each place in it."""
    order = np.lexsort(keys[::-1])
    edge = np.zeros(len(order), bool)
    for key in keys:
        s = key[order]
        edge[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(edge)


def merged(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sorted, disjoint, nonadjacent [lo, hi) spans covering the same, as one flat array."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    last = np.append(new[1:], True)
    return np.column_stack((lo[new], hi[last])).ravel()
