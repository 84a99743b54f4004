"""Substring dedup over bytes by a hash-compared suffix sort.

A byte goes when a string of 200 bytes that covers it also starts anywhere else, in
another document or in the same one. Suffixes are compared by prefix polynomial
hashes: a binary search over range hashes finds the common extension of two suffixes
in logarithmically many comparisons, and a merge sort over them orders suffixes with
their common lengths, which are then verified byte by byte.

Sorting every suffix of a corpus is not needed. Every 200-byte window has a minimiser
(its leftmost 40-byte gram of least hash), and equal windows have equal minimisers at
equal places.

1. Runs of windows with one minimiser are counted by it. A run whose minimiser is found
   nowhere else is done; nothing else is decided here.
2. The bytes of the other runs meet by their minimiser, as an anchor: first in the
   mapper's batch, of which one run of each content goes on, then in the shuffle. In both
   places the suffixes from the anchor on, and the reversed prefixes before it, are
   sorted; windows at offset o are equal where their left parts share o bytes and their
   right parts 200 - o. Every removal comes from these sorts.
3. An anchor that more runs share than one task should sort is split before any bytes
   are sent: the windows that reach far to the left take a longer anchor to the left, the
   others one to the right, twice a level, until no anchor is that common or the anchor
   is a whole window. So no string, however common, gathers its texts in one task.

Defined results: a null text is empty; texts under 200 bytes lose nothing; matches
never cross documents; repeated rows are copies like any others, so they lose what
recurs; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import blobs, spans
from framewright.llm.blobs import Columns
from framewright.llm.common import KEY, KEY_SCHEMA, chunks, cut, join_checked, keys, map_arrow, row_key, text_buffers, total_bytes
from framewright.llm.hashing import Prefixes, byte_values, mix, super_kmers

WINDOW, GRAM = 200, 40
#: Runs of one anchor that a task sorts; more common anchors are split.
HOT = 8_000
#: Split anchors that are sent to every task (8 bytes each). The next common one has at most (runs in all) / HOT_KEYS runs.
HOT_KEYS = 4 << 20
#: Text bytes whose runs are sorted together in a mapper, and run bytes sorted together in a reducer (or one anchor's).
TEXT_BYTES, SORT_BYTES = 2 << 20, 2 << 20

#: The k-th run of windows of a document by its minimiser a. kind 0: alone in its batch; 1: one of several (m contents); 2: a run to be sorted.
RUN = {"=a": "<u8"} | blobs.OWNER | {"k": "<i4", "m": "<i4", "kind": "u1"}
#: A run to be sorted.
PART = blobs.OWNER | {"k": "<i4", "=a": "<u8"}
#: A run with its bytes, by its anchor; kind 1: known to recur whole.
PIECE = {"=a": "<u8"} | spans.SPAN | {"at": "<i4", "kind": "u1"}


def bucket_of(a: np.ndarray, buckets: int) -> np.ndarray:
    return ((a >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def combine(parts: list[Columns], buckets: int) -> pa.RecordBatch:
    """Runs whose minimiser recurs within the batch will be sorted, whatever other batches hold; one record of each minimiser is sent on, so a hot one costs a record a batch."""
    c = blobs.concat(parts)
    order, group = blobs.groups(c["a"], c.pop("v"))
    a = c["a"][order]
    first = np.ones(len(a), bool)
    first[1:] = a[1:] != a[:-1]
    own = np.cumsum(first) - 1
    size = np.bincount(own)
    contents = np.bincount(own, np.diff(group, prepend=-1) != 0).astype(np.int32)
    several = size[own] > 1
    c = blobs.take(c, order) | {"m": contents[own], "kind": several.astype(np.uint8)}
    sure = blobs.take(c, several) | {"kind": np.full(int(several.sum()), 2, np.uint8)}
    on = blobs.take(c, first)
    bucket = np.concatenate((spans.bucket_of(sure, buckets), bucket_of(on["a"], buckets)))
    return blobs.batch_of(*blobs.scatter(blobs.concat([sure, on]), bucket, RUN))


def runs(texts: DataFrame, buckets: int, window: int, gram: int) -> DataFrame:
    """bucket, blob of RUN records of all texts; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Columns] = []
        size = 0
        for batch in chunks(batches):
            raw, offsets = text_buffers(batch.column("__text"))
            found = super_kmers(byte_values(raw), offsets, window, gram)
            doc = found["doc"]
            k = (np.arange(len(doc)) - np.searchsorted(doc, doc)).astype(np.int32)
            held.append({"a": found["a"], "v": found["v"], "k": k, **blobs.take(keys(batch), doc)})
            size += len(doc)
            if size >= blobs.GATHER:
                yield combine(held, buckets)
                held, size = [], 0
        if size:
            yield combine(held, buckets)

    return map_arrow(texts, run, "bucket long, blob binary")


def judge_runs(packed: DataFrame, buckets: int) -> DataFrame:
    """kind 1: the runs whose minimiser is found elsewhere too, packed by document; kind 2: a minimiser (bucket) of more than HOT contents and their number (n)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], RUN)
        live = blobs.take(c, c["kind"] < 2)
        order, own = blobs.groups(live["a"])
        live = blobs.take(live, order)
        many = np.bincount(own)[own] > 1 if len(own) else np.empty(0, bool)
        total = np.bincount(own, live["m"]).astype(np.int64)
        hot = np.flatnonzero(total > HOT)
        again = blobs.concat([blobs.take(c, c["kind"] == 2), blobs.take(live, many & (live["kind"] == 0))])
        again = blobs.take(again, np.lexsort((again["k"], again["tag"], again["id"])))
        numbers, rows = blobs.scatter(again, spans.bucket_of(again, buckets), PART)
        names = live["a"][np.searchsorted(own, hot)].view(np.int64)
        return pd.DataFrame({"bucket": numbers + names.tolist(), "kind": [1] * len(numbers) + [2] * len(hot), "n": [0] * len(numbers) + total[hot].tolist(), "blob": rows + [None] * len(hot)})

    return packed.groupBy("bucket").applyInPandas(run, "bucket long, kind int, n long, blob binary")


def most_common(found: DataFrame) -> np.ndarray:
    """The anchors of rows bucket, n: all of them, or the HOT_KEYS most common ones; sorted."""
    rows = found.orderBy(F.col("n").desc(), "bucket").limit(HOT_KEYS).select("bucket").toPandas()
    return np.sort(rows["bucket"].to_numpy(np.int64).view(np.uint64))


def parts_by_document(packed: DataFrame, hot: np.ndarray) -> DataFrame:
    """One row per document with runs to be sorted: KEY, __runs (a bit for each of its runs), __hot (whether one of them is split)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], PART)
        order, own = blobs.groups(*blobs.owner(c))
        c = blobs.take(c, order)
        cuts = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
        split, rows, hots = np.isin(c["a"], hot), [], []
        for a, b in zip(cuts, cuts[1:]):
            bits = np.zeros(int(c["k"][a:b].max()) + 1, bool)
            bits[c["k"][a:b]] = True
            rows.append(np.packbits(bits).tobytes())
            hots.append(bool(split[a:b].any()))
        return pd.DataFrame({f"__{k}": c[k][cuts[:-1]] for k in blobs.OWNER} | {"__runs": rows, "__hot": hots})

    return packed.groupBy("bucket").applyInPandas(run, f"{KEY_SCHEMA}, __runs binary, __hot boolean")


def halves(c: Columns, window: int) -> Columns:
    """Runs (start, n, and the anchor from s to e in the same coordinates) by longer anchors: windows that reach at least half of the rest to the left of their anchor, and the others."""
    free = window - (c["e"] - c["s"])
    half = (free + 1) // 2
    most, least = c["s"] - c["start"], c["s"] - c["start"] - c["n"] + 1
    whole, far, near = free <= 0, np.maximum(half, least), np.minimum(half - 1, most)
    left = c | {"n": np.where(whole, c["n"], most - far + 1), "s": np.where(whole, c["s"], c["s"] - half)}
    right = c | {"start": c["s"] - near, "n": near - least + 1, "e": c["e"] + free - half + 1}
    return blobs.concat([blobs.take(left, left["n"] > 0), blobs.take(right, ~whole & (right["n"] > 0))])


def split(c: Columns, sums: Prefixes, hots: list[np.ndarray], window: int) -> tuple[Columns, np.ndarray]:
    """The runs with every hot anchor split, level by level; and the level of each."""
    done, levels = [], []
    for level, hot in enumerate(hots):
        again = np.isin(c["a"], hot)
        done.append(blobs.take(c, ~again))
        levels.append(np.full(int((~again).sum()), level))
        c = halves(halves(blobs.take(c, again), window), window)
        c["a"] = mix(sums.ranges(c["s"], c["e"]) + np.uint64(level + 1))
    done.append(c)
    levels.append(np.full(len(c["a"]), len(hots)))
    return blobs.concat(done), np.concatenate(levels)


def pieces_of(batch: pa.RecordBatch, hots: list[np.ndarray], window: int, gram: int) -> tuple[Columns, np.ndarray, np.ndarray, np.ndarray]:
    """The runs to be sorted of a batch of texts with __runs (doc: number in the batch; start, s, e: places in its bytes), their levels, the bytes and the texts' offsets. Runs are found again, as their places would be more data than their bits."""
    raw, offsets = text_buffers(batch.column("__text"))
    held, at = [], 0
    for part in chunks(iter([batch])):
        own, first = text_buffers(part.column("__text"))
        found = super_kmers(byte_values(own), first, window, gram)
        count = np.bincount(found["doc"], minlength=part.num_rows)
        bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(part.column("__runs").to_pylist(), count.tolist())]
        found = blobs.take(found, np.concatenate(bits).astype(bool))
        start = offsets[at + found["doc"]] + found["lo"]
        held.append({"a": found["a"], "doc": at + found["doc"], "start": start, "n": found["n"], "s": start + found["at"], "e": start + found["at"] + gram})
        at += part.num_rows
    c = blobs.concat(held)
    c, level = split(c, Prefixes(byte_values(raw)), hots, window) if hots else (c, np.zeros(len(c["a"]), np.int64))
    return c, level, raw, offsets


def common_anchors(texts: DataFrame, parts: DataFrame, hots: list[np.ndarray], buckets: int, window: int, gram: int) -> DataFrame:
    """bucket (the anchor), n of the anchors of the last split that more than HOT contents share; counted, no bytes are sent."""
    rows = join_checked(texts, parts.where("__hot").drop("__hot"), KEY, F.length("__runs") + 40, "inner")
    fields = {"=a": "<u8", "m": "<i4"}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=TEXT_BYTES):
            c, level, raw, _ = pieces_of(batch, hots, window, gram)
            c = blobs.take(c, level == len(hots))
            v = Prefixes(byte_values(raw), 1).ranges(c["start"], c["start"] + c["n"] + window - 1)
            order, group = blobs.groups(c["a"], v, c["n"])
            a = c["a"][order][np.diff(group, prepend=-1) != 0]
            a, m = np.unique(a, return_counts=True)
            if len(a):
                yield blobs.batch_of(*blobs.scatter({"a": a, "m": m.astype(np.int32)}, bucket_of(a, buckets), fields))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], fields)
        a, own = np.unique(c["a"], return_inverse=True)
        total = np.bincount(own, c["m"]).astype(np.int64)
        return pd.DataFrame({"bucket": a[total > HOT].view(np.int64), "n": total[total > HOT]})

    return map_arrow(rows, count, "bucket long, blob binary").groupBy("bucket").applyInPandas(add, "bucket long, n long")


class Suffixes:
    """Pieces of a byte string, each from its start on for at most its length, compared by range hashes."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.raw, self.start, self.length = raw, start, length
        self.sums = Prefixes(byte_values(raw))
        self.most = int(length.max()) if len(length) else 0

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common lengths of pieces i and j: a binary search over hashes of equal-length prefixes."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.length[i], self.length[j])
        for _ in range(int(self.most).bit_length() + 1):
            mid = (low + high + 1) >> 1
            same = self.sums.ranges(a, a + mid) == self.sums.ranges(b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether piece i stands before piece j: by the first byte that differs, else the shorter first, else by number."""
        n = self.common(i, j)
        end_i, end_j = n >= self.length[i], n >= self.length[j]
        last = len(self.raw) - 1
        x, y = self.raw[np.minimum(self.start[i] + n, last)].astype(np.int64), self.raw[np.minimum(self.start[j] + n, last)].astype(np.int64)
        x, y = np.where(end_i, -1, x), np.where(end_j, -1, y)
        return np.where(x != y, x < y, i < j)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Piece numbers ordered within each group (group numbers are sorted): a bottom-up merge sort, all merges of a level at once."""
        order = np.arange(len(group))
        first = np.searchsorted(group, group)  # where each place's group starts
        size = np.bincount(group)[group] if len(group) else group
        width, largest = 1, int(size.max()) if len(size) else 0
        while width < largest:
            rank = np.arange(len(order)) - first
            block = first + rank // (2 * width) * (2 * width)
            middle = np.minimum(block + width, first + size)
            end = np.minimum(block + 2 * width, first + size)
            left = np.arange(len(order)) < middle
            low, high = np.where(left, middle, block), np.where(left, end, middle)
            base = low.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):  # how many of the other half stand before each piece
                mid = (low[open_] + high[open_]) >> 1
                before = self.less(order[mid], order[open_])
                low[open_], high[open_] = np.where(before, mid + 1, low[open_]), np.where(before, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            place = block + np.where(left, rank - (block - first), np.arange(len(order)) - middle) + (low - base)
            out = np.empty_like(order)
            out[place] = order
            order = out
            width *= 2
        return order

    def neighbours(self, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, bool]:
        """Common length of each ordered piece with the one before it in its group (0 at a group's start), verified on the bytes; and whether a hash collided."""
        out = np.zeros(len(order), np.int64)
        inner = np.flatnonzero(np.diff(group, prepend=-1) == 0)
        n = self.common(order[inner], order[inner - 1])
        a, b = self.start[order[inner]], self.start[order[inner - 1]]
        body = self.raw.tobytes()
        bad = [k for k, (x, y, m) in enumerate(zip(a.tolist(), b.tolist(), n.tolist())) if body[x : x + m] != body[y : y + m]]
        for x in bad:  # the true common length
            n[x] = int(np.argmax(self.raw[a[x] : a[x] + n[x]] != self.raw[b[x] : b[x] + n[x]]))
        out[inner] = n
        return out, len(bad) > 0

    def ordered(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted piece numbers and their neighbours' common lengths. After a collision the pieces are sorted again by their bytes."""
        order = self.sort(group)
        near, collided = self.neighbours(order, group)
        if collided:
            body = self.raw.tobytes()
            order = np.array(sorted(range(len(order)), key=lambda k: (group[k], body[self.start[k] : self.start[k] + self.length[k]], k)))
            near, _ = self.neighbours(order, group)
        return order, near


def shared_windows(a: np.ndarray, begin: np.ndarray, n: np.ndarray, at: np.ndarray, body: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What recurs among runs that share an anchor: whether a run recurs whole, whether it is the first of its content, and (run, window) numbers of windows that recur in other contents.

    Runs hold n + window - 1 bytes of body from begin on, with their anchor at `at`.
    """
    line, group = blobs.groups(a)
    begin, n, at, size = begin[line], n[line], at[line], n[line] + window - 1
    right = Suffixes(body, begin + at, size - at)
    left = Suffixes(body[::-1].copy(), len(body) - (begin + at), at)
    by_right, far = right.ordered(group)
    by_left, near = left.ordered(group)

    def classes(order: np.ndarray, common: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Class numbers of pieces whose neighbours share `least` bytes."""
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum((np.diff(group[order], prepend=-1) != 0) | (common < least))
        return out

    def longest(order: np.ndarray, length: np.ndarray) -> np.ndarray:
        own = length[order]
        return np.maximum(own, np.append(own[:1], own[:-1]))

    same, content = blobs.groups(classes(by_right, far, longest(by_right, right.length)), classes(by_left, near, longest(by_left, left.length)))
    whole, first = np.zeros(len(line), bool), np.zeros(len(line), bool)
    if len(line):
        whole[same] = np.bincount(content)[content] > 1
        first[same] = np.diff(content, prepend=-1) != 0
    # partial matches: one run of each content, in groups of several contents
    several = first & (np.bincount(group, first)[group] > 1) if len(group) else first
    where, what = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if several.any():
        kept_right, kept_left = by_right[several[by_right]], by_left[several[by_left]]
        (far, _), (near, _) = right.neighbours(kept_right, group[kept_right]), left.neighbours(kept_left, group[kept_left])
        most_right, most_left = np.zeros(len(line), np.int64), np.zeros(len(line), np.int64)
        most_right[kept_right] = np.maximum(far, np.append(far[1:], 0))
        most_left[kept_left] = np.maximum(near, np.append(near[1:], 0))
        open_ = np.flatnonzero(several & (most_right + most_left >= window))
        edge_right, edge_left = np.diff(group[kept_right], prepend=-1) != 0, np.diff(group[kept_left], prepend=-1) != 0
        right_class, left_class = np.empty(len(line), np.int64), np.empty(len(line), np.int64)
        lowest = int((window - most_right[open_]).min()) if len(open_) else 1
        for o in range(max(0, lowest), int(most_left[open_].max()) + 1 if len(open_) else 0):
            # pieces of one class share `o` bytes to the left and the rest of the window to the right
            own = open_[(o <= most_left[open_]) & (window - o <= most_right[open_]) & (o <= at[open_]) & (at[open_] - o < n[open_])]
            if not len(own):
                continue
            right_class[kept_right] = np.cumsum(edge_right | (far < window - o))
            left_class[kept_left] = np.cumsum(edge_left | (near < o))
            key = right_class[own] * (len(line) + 1) + left_class[own]
            sorted_ = np.argsort(key, kind="stable")
            equal = np.diff(key[sorted_]) == 0
            again = np.zeros(len(own), bool)
            again[sorted_[1:][equal]] = again[sorted_[:-1][equal]] = True
            where.append(line[own[again]])
            what.append((at[own] - o)[again])
    out_whole, out_first = np.empty_like(whole), np.empty_like(first)
    out_whole[line], out_first[line] = whole, first
    return out_whole, out_first, np.concatenate(where), np.concatenate(what)


def removed(c: Columns, whole: np.ndarray, number: np.ndarray, at: np.ndarray, window: int) -> Columns:
    """Spans to remove: runs that recur whole, and single windows (run number, window number), successive ones made one."""
    lo = np.concatenate((c["lo"][whole], c["lo"][number] + at)).astype(np.int64)
    n = np.concatenate((c["n"][whole] + window - 1, np.full(len(number), window))).astype(np.int64)
    own = {k: np.concatenate((c[k][whole], c[k][number])) for k in blobs.OWNER}
    order, _ = blobs.groups(*own.values(), lo)
    own, lo, n = blobs.take(own, order), lo[order], n[order]
    _, group = blobs.groups(*own.values())
    base = group.astype(np.int64) << 33  # keeps documents apart while ends are accumulated
    high = np.maximum.accumulate(base + lo + n) if len(lo) else lo
    new = np.ones(len(lo), bool)
    new[1:] = (base + lo)[1:] > high[:-1]
    cuts = np.flatnonzero(new)
    ends = high[np.append(cuts[1:], len(lo)) - 1] if len(cuts) else high
    return blobs.take(own, cuts) | {"lo": lo[cuts].astype(np.int32), "n": (ends - (base + lo)[cuts]).astype(np.int32)}


def bytes_of(body: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one after another."""
    total = np.cumsum(size)
    return body[np.repeat(begin - (total - size), size) + np.arange(total[-1] if len(total) else 0)]


def packed_pieces(c: Columns, body: np.ndarray, begin: np.ndarray, buckets: int, window: int) -> tuple[list[int], list[bytes]]:
    """PIECE records by bucket, each blob with the bytes of its runs behind them."""
    bucket = bucket_of(c["a"], buckets)
    order = np.lexsort((c["a"], bucket))
    cuts = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    rows = []
    for x, y in zip(cuts, cuts[1:]):
        own = order[x:y]
        head = blobs.pack(blobs.take(c, own), PIECE)
        rows.append(len(head).to_bytes(4, "little") + head + zstandard.compress(bytes_of(body, begin[own], c["n"][own].astype(np.int64) + window - 1).tobytes(), 3))
    return [int(bucket[order[x]]) for x in cuts[:-1]], rows


def sorted_in_batch(texts: DataFrame, parts: DataFrame, hots: list[np.ndarray], buckets: int, window: int, gram: int) -> DataFrame:
    """kind 0: spans to remove, by document; kind 1: one run of each content of the batch with its bytes, by anchor."""
    rows = join_checked(texts, parts.drop("__hot"), KEY, F.length("__runs") + 40, "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=TEXT_BYTES):
            c, _, raw, offsets = pieces_of(batch, hots, window, gram)
            whole, first, number, at = shared_windows(c["a"], c["start"], c["n"], c["s"] - c["start"], raw, window)
            start, lo = c["start"], (c["start"] - offsets[c["doc"]]).astype(np.int32)
            c = {"a": c["a"], **blobs.take(keys(batch), c["doc"]), "lo": lo, "n": c["n"].astype(np.int32), "at": (c["s"] - start).astype(np.int32), "kind": whole.astype(np.uint8)}
            gone, gone_rows = spans.spread(removed(c, whole, number, at, window), buckets)
            on, on_rows = packed_pieces(blobs.take(c, first), raw, start[first], buckets, window)
            columns = [pa.array(gone + on, pa.int64()), pa.array([0] * len(gone) + [1] * len(on), pa.int32()), pa.array(gone_rows + on_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "kind", "blob"])

    return map_arrow(rows, run, "bucket long, kind int, blob binary")


def sorted_in_bucket(packed: DataFrame, buckets: int, window: int) -> DataFrame:
    """Spans to remove, by document: those that batches have found, and those of the runs that they sent on. A slice of whole anchors is sorted at a time."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iloc[0] == 0:
            return pdf[["bucket", "blob"]]
        held, bodies = [], []
        for blob in pdf["blob"]:
            end = 4 + int.from_bytes(blob[:4], "little")
            held.append(blobs.unpack([blob[4:end]], PIECE))
            bodies.append(zstandard.decompress(blob[end:]))
        c, body = blobs.concat(held), np.frombuffer(b"".join(bodies), np.uint8)
        del held, bodies
        size = c["n"].astype(np.int64) + window - 1
        begin = np.cumsum(size) - size
        order, group = blobs.groups(c["a"])
        # anchors of a single run have nothing to be compared with
        order = order[np.bincount(group)[group] > 1]
        first = np.append(True, np.diff(c["a"][order].view(np.int64)) != 0)[: len(order)]
        total = np.cumsum(size[order])
        edges, out, x = np.append(np.flatnonzero(first), len(order)), [], 0
        while x < len(order):
            y = max(int(edges[np.searchsorted(edges, np.searchsorted(total, total[x] - size[order[x]] + SORT_BYTES), "right") - 1]), int(edges[np.searchsorted(edges, x, "right")]))
            own = order[x:y]
            part, n = blobs.take(c, own), size[own]
            whole, _, number, at = shared_windows(part["a"], np.cumsum(n) - n, part["n"].astype(np.int64), part["at"].astype(np.int64), bytes_of(body, begin[own], n), window)
            open_ = part["kind"] == 0
            out.append(removed(part, whole & open_, number[open_[number]], at[open_[number]], window))
            x = y
        numbers, rows = spans.spread(blobs.concat(out), buckets) if out else ([], [])
        return pd.DataFrame({"bucket": numbers, "blob": rows})

    return packed.groupBy("kind", "bucket").applyInPandas(run, "bucket long, blob binary")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """KEY, __spans: byte spans of every document that recur anywhere; cut."""
    texts = docs.select(*row_key(docs, id_col, text_col))
    buckets = blobs.buckets_for(total_bytes(docs, text_col))
    judged = cut(judge_runs(runs(texts, buckets, window, gram), buckets))
    hots = [most_common(judged.where("kind = 2"))]
    parts = cut(parts_by_document(judged.where("kind = 1").select("bucket", "blob"), hots[0]))
    free = window - gram
    while len(hots[-1]) and free > 0:
        free = free // 2 // 2  # the larger rest after two splits
        hots.append(most_common(cut(common_anchors(texts, parts, hots, buckets, window, gram))) if free > 0 else np.empty(0, np.uint64))
    found = sorted_in_batch(texts, parts, hots if len(hots[0]) else [], buckets, window, gram)
    return cut(spans.by_document(sorted_in_bucket(found, buckets, window)))


def keep(text: bytes, flat: np.ndarray) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, maximal removed runs, and the bytes that stay."""
    ends = [0, *flat.tolist(), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
    return len(text), len(text) - len(kept), len(flat) // 2, kept


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept (bytes; cuts may fall inside a character) and removed ([start, end) byte pairs, packed 32-bit) of every document."""
    rows = spans.with_spans(docs, repeated(docs, id_col, text_col, window, gram), id_col, text_col)
    fields = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("removed", pa.binary())]
    out = spans.apply_spans(rows, lambda t, f: (*keep(t, f), f.astype("<i4").tobytes()), fields, "n_bytes long, n_removed long, n_spans long, kept binary, removed binary")
    return out.withColumnRenamed("doc", id_col)


def digests(docs: DataFrame) -> DataFrame:
    rows = spans.with_spans(docs, repeated(docs), "doc_id", "text")

    def each(text: bytes, flat: np.ndarray) -> tuple[int, int, int, str]:
        n, removed, count, kept = keep(text, flat)
        return n, removed, count, hashlib.sha256(kept).hexdigest()

    fields = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    return spans.apply_spans(rows, each, fields, "n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("doc", "doc_id")
