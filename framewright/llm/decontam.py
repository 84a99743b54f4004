"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

Texts are normalised to lower-case (A-Z) words of letters, digits and non-ASCII
characters. Words are numbered, so windows that share words share their strings, and the
automaton runs over numbers; each text is scanned once, and the places of matches map
back to words and from there to byte spans of the original text.

An automaton holds PART_WINDOWS windows at most. A benchmark of more windows has several,
and a worker takes its texts through them one after another; a benchmark of more text
than one broadcast should carry is dealt into several passes by a hash of its items. The
hits of a document are united before they are counted, so the results are the same.

Defined results: null and empty texts have no words, no hits and are clean; items
without words never match; items of fewer words than a window match as one window;
repeated items and repeated rows each get their own result; null item ids are empty ones;
an empty benchmark leaves every document clean; an empty table gives an empty one. Only
the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from framewright.llm.common import KEY, KEY_SCHEMA, chunks, cut, join_checked, map_arrow, row_key

WINDOW = 13
#: A document is contaminated when at least one word in so many is hit.
ONE_IN = 20
#: Windows of one automaton (some 0.4 KB each).
PART_WINDOWS = 250_000
#: Benchmark bytes of one pass, which are sent to every executor.
PASS_BYTES = 16 << 20
#: Text bytes that a worker takes through several automata at a time.
HELD_BYTES = 32 << 20

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

Item = tuple[str, str]


def normalised(text: str) -> list[bytes]:
    """Normalised words; separators are single ASCII bytes, so UTF-8 bytes can be split as they are."""
    return text.encode().translate(_TABLE).split()


class Benchmark:
    """The items' windows as automata over word numbers; parts are built when they are asked for, and the last one is kept."""

    def __init__(self, items: list[Item], window: int = WINDOW, part_windows: int = PART_WINDOWS):
        self.names = [name for name, _ in items]
        self.numbers: dict[bytes, int] = {}
        self.window = window
        self.items = [tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in normalised(text)) for _, text in items]
        # (item, first window, end) of each part; an item may be in several
        self.parts: list[list[tuple[int, int, int]]] = []
        room = 0
        for number, words in enumerate(self.items):
            at, total = 0, max(1, len(words) - window + 1) if words else 0
            while at < total:
                if room == 0:
                    self.parts.append([])
                    room = part_windows
                end = min(total, at + room)
                self.parts[-1].append((number, at, end))
                room -= end - at
                at = end
        self.kept: tuple[int, tuple] | None = None

    def part(self, k: int) -> tuple:
        """The automaton of a part, and by its values the sizes of windows and the items that hold them."""
        if self.kept is None or self.kept[0] != k:
            self.kept = None
            built = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            sizes, holders = [], []
            for number, first, end in self.parts[k]:
                for at in range(first, end):
                    words = self.items[number][at : at + self.window]
                    known = built.get(words, -1)
                    if known < 0:
                        known = len(sizes)
                        built.add_word(words, known)
                        sizes.append(len(words))
                        holders.append([])
                    if not holders[known] or holders[known][-1] != number:
                        holders[known].append(number)
            built.make_automaton()
            self.kept = k, (built, sizes, holders)
        return self.kept[1]

    def scan(self, texts: list[str]) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
        """Of each text the number of words, merged [first, end) runs of hit words and the numbers of the items found."""
        lines = [tuple(map(self.numbers.get, normalised(t), repeat(0))) for t in texts]
        hits: list[list[tuple[int, int]]] = [[] for _ in texts]
        found: list[set[int]] = [set() for _ in texts]
        for k in range(len(self.parts)):
            built, sizes, holders = self.part(k)
            for line, own, items in zip(lines, hits, found):
                if line:
                    for end, value in built.iter(line):
                        own.append((end + 1 - sizes[value], end + 1))
                        items.update(holders[value])
        return [(len(line), merged(own), items) for line, own, items in zip(lines, hits, found)]


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for first, end in sorted(hits):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([first, end])
    return [(a, b) for a, b in runs]


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[int]:
    """The runs of words as byte offsets into the original text: start, end, start, end ..."""
    if not runs:
        return []
    kept = np.frombuffer(text.encode().translate(_TABLE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], kept.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    return [int(x) for a, b in runs for x in (starts[a], ends[b - 1])]


_loaded: dict[str, Benchmark] = {}


def load(name: str, packed: bytes, window: int, part_windows: int) -> Benchmark:
    """The worker's automata of a benchmark; those of the one before go."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Benchmark(pickle.loads(zstandard.decompress(packed)), window, part_windows)
    return _loaded[name]


def passes(benchmark: DataFrame, item_id: str, item_text: str) -> list[list[Item]]:
    """The distinct items, dealt into passes of at most PASS_BYTES each (or one item)."""
    rows = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("t")).distinct()
    n = 1
    while True:
        dealt = rows.withColumn("p", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
        size = F.sum(F.octet_length("t") + F.octet_length("i")).cast("long")
        most = dealt.groupBy("p").agg(size.alias("size"), F.count("*").alias("items")).where(f"items > 1 and size > {PASS_BYTES}").agg(F.max("size")).first()[0]
        if most is None:
            return [sorted((r["i"], r["t"]) for r in dealt.where(F.col("p") == p).collect()) for p in range(n)]
        n *= max(2, -(-most // PASS_BYTES))


def scanned(texts: DataFrame, keep: list[str], items: list[Item], window: int, schema: str, row) -> DataFrame:
    """row(text, names, number of words, runs, items found) of every text, None to leave it out, beside its columns `keep`; one narrow pass."""
    packed = zstandard.compress(pickle.dumps(items), 3)
    name, part_windows, held = hashlib.sha256(packed).hexdigest() + f":{window}", PART_WINDOWS, HELD_BYTES
    fields = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(name, packed, window, part_windows)
        for batch in gathered(batches, held) if len(own.parts) > 1 else batches:
            texts = batch.column("__text").to_pylist()
            out = [row(t, own.names, *x) for t, x in zip(texts, own.scan(texts))]
            mask = pa.array([x is not None for x in out], pa.bool_())
            columns = list(zip(*(x for x in out if x is not None))) or [()] * len(fields)
            kinds = {"long": pa.int64(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}
            made = [pa.array(list(c), kinds[f.split()[1]]) for c, f in zip(columns, schema.split(", "))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).filter(mask) for k in keep), *made], names=[*keep, *fields])

    return map_arrow(texts, run, StructType([*(texts.schema[k] for k in keep), *StructType.fromDDL(schema)]))


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to so many text bytes, so that several automata are built less often."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in chunks(batches, most=most):
        held.append(batch)
        size += batch.column("__text").nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _result(text, names, n, runs, found):
    return n, sum(b - a for a, b in runs), sorted({names[i] for i in found}), original_spans(text, runs)


def _hits(text, names, n, runs, found):
    return ([x for run in runs for x in run], sorted({names[i] for i in found})) if found else None


def _united(texts: DataFrame, dealt: list[list[Item]], window: int) -> DataFrame:
    """KEY, runs, items of the documents with hits, over all passes; cut."""
    each = [scanned(texts, KEY, items, window, "runs array<long>, items array<string>", _hits) for items in dealt]
    rows = reduce(DataFrame.unionByName, (e.dropDuplicates(KEY) for e in each))
    return cut(rows.groupBy(*KEY).agg(F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))


_RESULT = "n_words long, n_hit long, items array<string>, spans array<long>"


def _counted(texts: DataFrame, keep: list[str], dealt: list[list[Item]], window: int) -> DataFrame:
    """texts (keep, KEY and __text) with the hits of several passes, united and counted."""
    rows = join_checked(texts, _united(texts.select(*KEY, "__text"), dealt, window), KEY, F.size("runs") * 8 + F.size("items") * 24 + 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, flat, items in zip(*(batch.column(k).to_pylist() for k in ("__text", "runs", "items"))):
                runs = merged(list(zip((flat or [])[::2], (flat or [])[1::2])))
                out.append((len(normalised(text)), sum(b - a for a, b in runs), sorted(items or []), original_spans(text, runs)))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out) if out else [()] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), *columns], names=[*keep, "n_words", "n_hit", "items", "spans"])

    return map_arrow(rows, run, StructType([*(texts.schema[k] for k in keep), *StructType.fromDDL(_RESULT)]))


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: id, n_words, n_hit, items (ids as sorted strings), spans (byte offsets in the original). One narrow pass unless the benchmark is larger than a broadcast; its size is measured first."""
    dealt = passes(benchmark, item_id, item_text)
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), *row_key(docs, id_col, text_col))
    found = scanned(texts.select("doc", "__text"), ["doc"], dealt[0], window, _RESULT, _result) if len(dealt) == 1 else _counted(texts, ["doc"], dealt, window)
    return found.withColumnRenamed("doc", id_col)


def contaminated(n_hit="n_hit", n_words="n_words", one_in: int = ONE_IN):
    return (F.col(n_hit) > 0) & (F.col(n_hit) * one_in >= F.col(n_words))


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever their names; decided in one narrow pass over each row unless the benchmark needs several."""
    dealt = passes(benchmark, item_id, item_text)
    rows = docs.select(*row_key(docs, id_col, text_col), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    if len(dealt) == 1:
        def verdict(text, names, n, runs, found):
            return (True,) if not runs or ONE_IN * sum(b - a for a, b in runs) < n else None

        return scanned(rows.select("__text", "__row"), ["__row"], dealt[0], WINDOW, "__stays boolean", verdict).select("__row.*")
    gone = cut(_counted(rows.select(*KEY, "__text").dropDuplicates(KEY), KEY, dealt, WINDOW).where(contaminated()).select(*KEY))
    return join_checked(rows, gone, KEY, F.lit(40), "left_anti").select("__row.*")
