"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride binary shards.

Each document becomes its token ids and an end mark, cut into sequences of a fixed
length (the last one padded with end marks). Sequences are numbered densely in the
order of (doc_id, text hash, place); a keyed Feistel network over the least even number
of bits, walked along its cycle until it falls below the total, is a permutation of
those numbers, and its value is the sequence's slot. Slot ranges of a fixed size are
shards: one file each, whose records have one stride, so any slot's bytes are found by
arithmetic and reading can stop and resume anywhere.

Tokens are made once: batches of documents are tokenised into a table of packed rows in
the shared folder, their sequences are counted and numbered from its keys, and a second
narrow pass over the table deals the sequences to their shards. Both copies are
compressed; a lost task is made again from the table.

Defined results: null and empty texts have one sequence of end marks only; rows that
repeat both doc_id and text are one document and are written once; rows that share a
doc_id only are separate; an empty table has no shards; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewright.llm import bulk_bpe
from framewright.llm.common import KEY, cut, join_checked, map_arrow, row_key, shared_dir
from framewright.llm.hashing import mix

#: Tokens of a sequence; sequences of a shard; key of the order; end mark.
LENGTH, SHARD, SEED, END = 256, 16_384, 20_240_501, 49_407
ROUNDS = 6
#: Sequences packed together before the shuffle.
PACK = 32_000
#: Compression levels of the token table, written once, and of the shuffled sequences.
TABLE_LEVEL, SHUFFLE_LEVEL = 6, 3


def permute(index: np.ndarray, total: int, key: int = SEED) -> np.ndarray:
    """The slots of sequence numbers: a keyed permutation of range(total)."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key % (1 << 62)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    outside = np.flatnonzero(out >= np.uint64(total))
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= np.uint64(total)]
    return out.astype(np.int64)


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """batch, docs (KEY and n, the number of sequences, of its documents), sizes (bytes of each one's ids, packed) and ids (packed) of every batch of documents; cut. The only pass that tokenises."""
    rows = docs.select(*row_key(docs, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bulk_bpe.load(path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = coder.encode(batch.column("__text").to_pylist())
            sizes = np.array([len(x) for x in ids], "<i8")
            keys = pa.StructArray.from_arrays([*map(batch.column, KEY), pa.array(sizes // (2 * length) + 1)], names=[*KEY, "n"])
            packed = [_squeeze(sizes.tobytes(), TABLE_LEVEL), _squeeze(b"".join(ids), TABLE_LEVEL)]
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), keys), *(pa.array([x], pa.binary()) for x in packed)], names=["batch", "docs", "sizes", "ids"])
            number += 1

    return cut(map_arrow(rows, run, "batch long, docs array<struct<__id: bigint, __tag: bigint, __top: int, n: bigint>>, sizes binary, ids binary"))


def place(tokens: DataFrame) -> tuple[DataFrame, int]:
    """batch, first (the number of each document's first sequence, in the batch's order; cut) and the total number of sequences. Only keys and counts are shuffled."""
    own = tokens.select("batch", F.posexplode("docs").alias("at", "d")).select("batch", "at", "d.*")
    counts = own.groupBy(*KEY).agg(F.max("n").alias("n"))
    ranges = cut(counts.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("range", F.spark_partition_id()))
    sums = ranges.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect()  # a row for each partition
    before, total = [], 0
    for r in sums:
        before.append((r["range"], total))
        total += r["n"]
    offsets = tokens.sparkSession.createDataFrame(before or [(0, 0)], "range int, offset long")
    inside = Window.partitionBy("range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.join(F.broadcast(offsets), "range").select(*KEY, (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first"))
    placed = own.drop("n").join(first, KEY).groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("at", "first"))).alias("f"))
    return cut(placed.select("batch", F.col("f.first").alias("first"))), total


def sequences(tokens: DataFrame, first: DataFrame, total: int, length: int, shard: int, key: int, end: int) -> DataFrame:
    """shard, blob: slots within the shard and their tokens, packed."""
    rows = join_checked(tokens.select("batch", "sizes", "ids"), first, ["batch"], F.size("first") * 8 + 32, "inner")

    def flush(tokens: list[bytes], numbers: list[np.ndarray]) -> pa.RecordBatch:
        slot = permute(np.concatenate(numbers), total, key)
        body = np.frombuffer(b"".join(tokens), "<u2").reshape(-1, length)
        order = np.argsort(slot, kind="stable")
        slot, body = slot[order], body[order]
        own = slot // shard
        cuts = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
        packed = [_pack(slot[a:b] % shard, body[a:b]) for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(own[cuts[:-1]]), pa.array(packed, pa.binary())], names=["shard", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = end.to_bytes(2, "little")
        tokens: list[bytes] = []
        numbers: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for sizes, ids, starts in zip(batch.column("sizes"), batch.column("ids"), batch.column("first")):
                sizes, ids, at = np.frombuffer(zstandard.decompress(sizes.as_py()), "<i8").tolist(), zstandard.decompress(ids.as_py()), 0
                for own, start in zip(sizes, starts.as_py()):
                    n = own // (2 * length) + 1
                    tokens += (ids[at : at + own], mark * (n * length - own // 2))
                    numbers.append(np.arange(start, start + n))
                    at += own
                    size += n
                    if size >= PACK:
                        yield flush(tokens, numbers)
                        tokens, numbers, size = [], [], 0
        if size:
            yield flush(tokens, numbers)

    return map_arrow(rows, run, "shard long, blob binary")


def _squeeze(data: bytes, level: int) -> bytes:
    return zstandard.compress(data, level)


def _pack(slots: np.ndarray, body: np.ndarray) -> bytes:
    return len(slots).to_bytes(4, "little") + slots.astype("<i4").tobytes() + _squeeze(body.tobytes(), SHUFFLE_LEVEL)


def _unpack(blob: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    return np.frombuffer(blob, "<i4", n, 4), np.frombuffer(zstandard.decompress(blob[4 + 4 * n :]), "<u2").reshape(n, length)


def shard_name(number: int) -> str:
    return f"shard-{number:08d}.bin"


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD, key: int = SEED, end: int = END) -> DataFrame:
    """Writes the shards into `folder` (a URI that all executors share) and returns shard, first_slot, n_sequences, n_bytes, sha256 of each.

    A shard holds at most `shard` sequences, so a task's memory is bounded. Contents
    depend on the documents and the key only, and each file appears by a rename, so lost
    tasks are simply run again.
    """
    tokens = tokenised(docs, path, id_col, text_col, length)
    first, total = place(tokens)

    def save(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["shard"].iloc[0])
        size = min(shard, total - number * shard)
        out, seen = np.zeros((size, length), "<u2"), np.zeros(size, bool)
        for blob in pdf["blob"]:
            slots, body = _unpack(blob, length)
            out[slots], seen[slots] = body, True
        if not seen.all():
            raise ValueError(f"shard {number} lacks {int((~seen).sum())} sequences")
        data = out.tobytes()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part = f"{base}/.{shard_name(number)}.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as f:
            f.write(data)
        store.move(part, f"{base}/{shard_name(number)}")
        return pd.DataFrame({"shard": [number], "first_slot": [number * shard], "n_sequences": [size], "n_bytes": [len(data)], "sha256": [hashlib.sha256(data).hexdigest()]})

    packed = sequences(tokens, first, total, length, shard, key, end)
    return packed.groupBy("shard").applyInPandas(save, "shard long, first_slot long, n_sequences long, n_bytes long, sha256 string")


def read(folder: str, start: int, count: int, length: int = LENGTH, shard: int = SHARD) -> Iterator[np.ndarray]:
    """The sequences of slots start, start + 1 ... in training order, by seeking; a later call resumes where one stopped."""
    store, base = fs.FileSystem.from_uri(folder)
    stride, slot = length * 2, start
    while slot < start + count:
        number, at = divmod(slot, shard)
        name = f"{base}/{shard_name(number)}"
        if store.get_file_info(name).type == fs.FileType.NotFound:
            return
        with store.open_input_file(name) as f:
            f.seek(at * stride)
            data = f.read(min(shard - at, start + count - slot) * stride)
        if not data:
            return
        for row in np.frombuffer(data, "<u2").reshape(-1, length):
            yield row
            slot += 1


def materialise(docs: DataFrame, path: str) -> DataFrame:
    """write() into a new folder beside the checkpoints."""
    return write(docs, path, f"{shared_dir(docs.sparkSession)}/token-shards-{uuid.uuid4().hex}")
