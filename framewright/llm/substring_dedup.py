"""Substring dedup over token k-mers: a compacted de Bruijn graph with source coordinates.

A window of 20 words is an edge of the de Bruijn graph of 19-word nodes. Within a text,
consecutive edges with the same minimiser form one path piece (super-k-mer); equal
pieces of all texts meet by their hash in one grouped shuffle. Every occurrence of a
piece that recurs carries its coordinates (document, first window) and its source, an
earlier occurrence. Pieces that are the first of their content, but share the minimiser
with other contents (the graph branches inside them), are taken apart into single edges,
which are compared by hash; so partial overlaps count to the word.

The recurring pieces and edges are then the vertices of the graph of repeats. Each has
what follows and what precedes it, over all of its occurrences: one neighbour, several,
or one that does not recur. Two vertices that have only each other are joined, and the
nonbranching paths of such joints are compacted by pointer doubling, a Spark join a
round. Wherever the first vertex of a path occurs, the whole path follows, so only
occurrences of first vertices go on, with the path's length. Consecutive paths of one
document that repeat a source at one distance are one long span, and each span is
verified: both sides' words are read by their coordinates, through a join with the
texts, and their digests must be equal.

Order: a window starts earlier if its doc_id is smaller (null before all) or, in the
same document, if its place is smaller. Windows are judged on the input.

Defined results: null and empty texts have no words; texts of fewer than 20 words
lose nothing; rows that repeat a doc_id with the same text are one document (none is
earlier than the other, both get the same result); rows that share a doc_id but not
the text do not count as earlier than each other. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import blobs, spans
from framewright.llm.blobs import Columns
from framewright.llm.common import KEY, chunks, cut, ints, join_checked, keys, map_arrow, row_key, text_buffers, total_bytes
from framewright.llm.hashing import Prefixes, Words, super_kmers

WINDOW, MINIMISER = 20, 7

#: A span of words and its earlier occurrence.
COPY = spans.SPAN | {f"s{k}": kind for k, kind in (blobs.OWNER | {"lo": "<i4"}).items()}
#: What became of a record in its batch: first of its content there, later than another, or first with later ones.
ALONE, LATE, FOLLOWED = 0, 1, 2
#: A path piece: minimiser, content hash, document, first window, number of windows, kind, and (if late) the earlier occurrence.
PIECE = {"=a": "<u8", "=v": "<u8"} | COPY | {"kind": "u1"}
#: An edge: the same, its content being its hash and its windows one.
EDGE = {"=a": "<u8"} | COPY | {"kind": "u1"}
#: An occurrence of a vertex of the graph of repeats: its content, first window, windows, source (the first of a content is its own) and level (0 pieces, 1 edges).
OCCURRENCE = {"=v": "<u8"} | COPY | {"level": "u1"}


def previous(c: Columns, *keys: str, followed: np.ndarray | None = None) -> tuple[np.ndarray, Columns, np.ndarray]:
    """Whether a record of the same keys has a smaller (id, lo); the coordinates of the last such record; whether any record of the same keys is late, or marked as followed. Records of one (id, lo) tie: neither is later.

    The last one, not the first: a text that repeats a phrase then copies itself at one
    distance, and a copy of a copy points to its neighbour, so paths are long and no
    single source serves a whole group.
    """
    order, place = blobs.groups(*(c[k] for k in keys), c["id"], c["lo"])
    _, own = blobs.groups(*(c[k] for k in keys))  # group numbers by keys only, in the same order of keys
    before = np.flatnonzero(np.diff(place, prepend=-1))[place] - 1 if len(order) else order
    has = (before >= 0) & (own[before] == own)
    late, source = np.empty(len(order), bool), np.empty(len(order), np.int64)
    late[order], source[order] = has, order[np.maximum(before, 0)]
    again = has if followed is None else has | followed[order]
    recurs = np.empty(len(order), bool)
    recurs[order] = (np.bincount(own, weights=again) > 0)[own] if len(order) else again
    return late, {f"s{k}": c[k][source] for k in (*blobs.OWNER, "lo")}, recurs


def occurrences(gone: Columns, live: Columns, late: np.ndarray, recurs: np.ndarray, content: str, level: int) -> Columns:
    """The fields of OCCURRENCE of every record whose content recurs."""
    first = blobs.take(live, ~late & recurs)
    first |= {f"s{k}": first[k] for k in (*blobs.OWNER, "lo")}
    c = blobs.concat([gone, blobs.take(live, late), first])
    return c | {"v": c[content], "level": np.full(len(c["lo"]), level, np.uint8)}


def bucket_of(a: np.ndarray, buckets: int) -> np.ndarray:
    return ((a >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def combine(parts: list[Columns], keys: tuple[str, ...], fields: dict[str, str], buckets: int) -> pa.RecordBatch:
    """One batch's records: those that are later than another of the batch are marked as late, so one per key goes on as a candidate."""
    c = blobs.concat(parts)
    late, source, recurs = previous(c, *keys)
    c |= {k: np.where(late, x, 0) for k, x in source.items()} | {"kind": np.where(late, LATE, np.where(recurs, FOLLOWED, ALONE)).astype(np.uint8)}
    # late records are settled; they travel with their document, and need their content only
    bucket = np.where(late, spans.bucket_of(c, buckets), bucket_of(c["a"], buckets))
    if "v" in c:
        c["a"] = np.where(late, np.uint64(0), c["a"])
    order = np.argsort(late, kind="stable")
    return blobs.batch_of(*blobs.scatter(blobs.take(c, order), bucket[order], fields))


def fresh(batch: pa.RecordBatch, seen: set[tuple]) -> pa.RecordBatch:
    """The rows whose document is not among seen, which they join: a document that many rows repeat is read once for the records that are gathered."""
    known = [(key in seen, seen.add(key))[0] for key in zip(*(batch.column(k).to_pylist() for k in KEY))]
    return batch.filter(pa.array([not k for k in known])) if any(known) else batch


def pieces(texts: DataFrame, buckets: int, window: int, k: int) -> DataFrame:
    """bucket, blob of PIECE records of all texts; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Columns] = []
        size, seen = 0, set()
        for batch in chunks(batches):
            batch = fresh(batch, seen)
            if not batch.num_rows:
                continue
            raw, offsets = text_buffers(batch.column("__text"))
            words = Words(raw, offsets)
            found = super_kmers(words.hashes(), words.first, window, k)
            doc = found.pop("doc")
            found.pop("at")
            held.append(found | blobs.take(keys(batch), doc))
            size += len(doc)
            if size >= blobs.GATHER:
                yield combine(held, ("a", "v"), PIECE, buckets)
                held, size, seen = [], 0, set()
        if size:
            yield combine(held, ("a", "v"), PIECE, buckets)

    return map_arrow(texts, run, "bucket long, blob binary")


def judge_pieces(packed: DataFrame, buckets: int) -> DataFrame:
    """kind 0: OCCURRENCE records of recurring pieces, by document; kind 1: pieces whose edges must be compared one by one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], PIECE)
        gone = c["kind"] == LATE
        live = blobs.take(c, ~gone)
        late, source, recurs = previous(live, "a", "v", followed=live["kind"] == FOLLOWED)
        live |= source
        first = blobs.take(live, ~late)
        # contents of a minimiser: a group with several has a branch inside
        order, group = blobs.groups(first["a"], first["v"])
        _, own = blobs.groups(first["a"])
        cuts = np.flatnonzero(np.diff(own, prepend=-1))
        contents = np.diff(np.append(group[cuts], group[-1] + 1 if len(group) else 0))
        branch = blobs.take(first, order[contents[own] > 1]) if len(order) else first
        numbers, packed_rows = spans.spread(occurrences(blobs.take(c, gone), live, late, recurs, "v", 0), buckets, OCCURRENCE)
        more, more_rows = spans.spread(branch, buckets)
        return pd.DataFrame({"bucket": numbers + more, "kind": [0] * len(numbers) + [1] * len(more), "blob": packed_rows + more_rows})

    return packed.groupBy("bucket").applyInPandas(run, "bucket long, kind int, blob binary")


def edges(texts: DataFrame, branches: DataFrame, buckets: int, window: int) -> DataFrame:
    """bucket, blob of EDGE records: the single windows of the given pieces."""
    rows = join_checked(texts, branches, KEY, F.length("__spans") + 32, "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Columns] = []
        size, seen = 0, set()
        for batch in chunks(batches):
            batch = fresh(batch, seen)
            if not batch.num_rows:
                continue
            raw, offsets = text_buffers(batch.column("__text"))
            words = Words(raw, offsets)
            grams = Prefixes(words.hashes()).grams(window)
            doc, lo = [], []
            for number, flat in enumerate(batch.column("__spans").to_pylist()):
                pairs = np.frombuffer(flat, "<i4").reshape(-1, 2)
                lo += [np.arange(a, b) for a, b in pairs]
                doc.append(np.full(int((pairs[:, 1] - pairs[:, 0]).sum()), number))
            doc, lo = np.concatenate(doc), np.concatenate(lo).astype(np.int32)
            held.append({"a": grams[words.first[doc] + lo], **blobs.take(keys(batch), doc), "lo": lo, "n": np.ones(len(lo), np.int32)})
            size += len(doc)
            if size >= blobs.GATHER:
                yield combine(held, ("a",), EDGE, buckets)
                held, size, seen = [], 0, set()
        if size:
            yield combine(held, ("a",), EDGE, buckets)

    return map_arrow(rows, run, "bucket long, blob binary")


def judge_edges(packed: DataFrame, buckets: int) -> DataFrame:
    """OCCURRENCE records of recurring edges, by document."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], EDGE)
        gone = c["kind"] == LATE
        live = blobs.take(c, ~gone)
        late, source, recurs = previous(live, "a", followed=live["kind"] == FOLLOWED)
        numbers, rows = spans.spread(occurrences(blobs.take(c, gone), live | source, late, recurs, "a", 1), buckets, OCCURRENCE)
        return pd.DataFrame({"bucket": numbers, "blob": rows})

    return packed.groupBy("bucket").applyInPandas(run, "bucket long, blob binary")


#: Fields that name a span's document, and those of its source.
OWN, SOURCE = [*blobs.OWNER], [f"s{k}" for k in blobs.OWNER]
_SPAN_SCHEMA = "id long, tag long, top int, lo int, n int"
#: What a vertex's occurrences say of it: its windows, and the contents after and before it (0: none that recurs).
_SAID = ("n", "after", "before")


def in_order(packed: pd.Series) -> Columns:
    """The occurrences of some documents, by document, level and place; those of repeated rows once."""
    c = blobs.unpack(packed, OCCURRENCE)
    order, group = blobs.groups(*blobs.owner(c), c["level"], c["lo"])
    return blobs.take(c, order[np.diff(group, prepend=-1) > 0])


def vertices(found: DataFrame) -> DataFrame:
    """bucket, v and the least and most of what the bucket's occurrences say of each vertex: as many rows for a vertex as buckets, however often it occurs. Cut."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = in_order(pdf["blob"])
        v = c["v"].view(np.int64)
        _, part = blobs.groups(*blobs.owner(c), c["level"])
        meets = (part[1:] == part[:-1]) & (c["lo"][1:] == c["lo"][:-1] + c["n"][:-1])
        said = {"n": c["n"], "after": np.zeros_like(v), "before": np.zeros_like(v)}
        said["after"][:-1], said["before"][1:] = np.where(meets, v[1:], 0), np.where(meets, v[:-1], 0)
        order, group = blobs.groups(v)
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        out = {"bucket": np.full(len(cuts), pdf["bucket"].iat[0]), "v": v[order][cuts]}
        for k, x in said.items():
            out |= {f"{k}_least": np.minimum.reduceat(x[order], cuts), f"{k}_most": np.maximum.reduceat(x[order], cuts)}
        return pd.DataFrame(out)

    fields = ", ".join(f"{k}_{end} {'int' if k == 'n' else 'long'}" for k in _SAID for end in ("least", "most"))
    return cut(found.groupBy("bucket").applyInPandas(run, f"bucket long, v long, {fields}"))


def unitigs(said: DataFrame) -> DataFrame:
    """v, length: the windows of the path that a vertex begins, 0 for the vertices inside a path; vertices that are a path alone have no row. Cut.

    A vertex inside a path points back at the one before it, and the pointers are doubled
    until all reach the path's first vertex: rounds grow with the logarithm of the longest
    path. A path has no cycle: in every text that a cycle passes, its last vertex there
    is followed by something else.
    """
    whole = said.groupBy("v").agg(*(f(f"{k}_{end}").alias(f"{k}_{end}") for k in _SAID for f, end in ((F.min, "least"), (F.max, "most"))))

    def only(k: str) -> Column:
        return F.when((F.col(f"{k}_least") == F.col(f"{k}_most")) & (F.col("n_least") == F.col("n_most")) & (F.col(f"{k}_least") != 0), F.col(f"{k}_least"))

    nodes = cut(whole.select("v", F.col("n_least").alias("n"), *(only(k).alias(k) for k in _SAID[1:])))
    left = nodes.where("after is not null").select(F.col("v").alias("up"), F.col("n").alias("back"), F.col("after").alias("v"))
    inner = nodes.where("before is not null").select("v", "n", F.col("before").alias("up"))
    # back: windows from the start of `up` to the start of v
    state = cut(inner.join(left, ["v", "up"]).select("v", "n", "up", "back", F.lit(False).alias("done")))
    while not state.where("not done").isEmpty():
        there = state.select(F.col("v").alias("up"), F.col("up").alias("further"), F.col("back").alias("more"), F.col("done").alias("last"))
        step = state.where("not done").join(there, "up", "left")
        moved = step.select("v", "n", F.coalesce("further", "up").alias("up"), (F.col("back") + F.coalesce("more", F.lit(0))).alias("back"), F.coalesce("last", F.lit(True)).alias("done"))
        state = cut(state.where("done").unionByName(moved))
    heads = state.groupBy(F.col("up").alias("v")).agg(F.max(F.col("back") + F.col("n")).cast("int").alias("length"))
    return cut(heads.unionByName(state.select("v", F.lit(0).alias("length"))))


def paths(found: DataFrame, said: DataFrame, lengths: DataFrame, window: int) -> DataFrame:
    """Every path's later occurrences, consecutive ones of one source at one distance as one span: the fields of COPY, n in words. Only first vertices of paths count."""
    firsts = said.select("bucket", "v").join(lengths, "v", "left").where("length is null or length > 0")

    def run(pdf: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
        c = in_order(pdf["blob"])
        by = np.argsort(heads["v"].to_numpy())
        known, length = heads["v"].to_numpy()[by], heads["length"].fillna(0).to_numpy().astype(np.int32)[by]
        v = c["v"].view(np.int64)
        at = np.minimum(np.searchsorted(known, v), max(len(known) - 1, 0))
        begins = known[at] == v if len(known) else np.zeros(len(v), bool)
        own = np.logical_and.reduce([c[k] == c[f"s{k}"] for k in (*OWN, "lo")])
        if len(known):
            c["n"] = np.where(length[at] > 0, length[at], c["n"]) + np.int32(window - 1)
        c = blobs.take(c, begins & ~own)
        shift = c["lo"].astype(np.int64) - c["slo"]
        order, _ = blobs.groups(*(c[k] for k in OWN + SOURCE), shift, c["lo"])
        c = blobs.take(c, order)
        _, line = blobs.groups(*(c[k] for k in OWN + SOURCE), shift[order])
        base = line.astype(np.int64) << 33  # keeps the groups apart while ends are accumulated
        lo, hi = base + c["lo"], np.maximum.accumulate(base + c["lo"] + c["n"])
        new = np.ones(len(lo), bool)
        new[1:] = lo[1:] > hi[:-1]
        cuts = np.flatnonzero(new)
        ends = hi[np.append(cuts[1:], len(lo)) - 1] if len(cuts) else hi
        return pd.DataFrame({k: x for k, x in (blobs.take(c, cuts) | {"n": (ends - lo[cuts]).astype(np.int32)}).items() if k in COPY})

    return found.groupBy("bucket").cogroup(firsts.groupBy("bucket")).applyInPandas(run, f"{_SPAN_SCHEMA}, sid long, stag long, stop int, slo int")


def digests_of_spans(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every wanted span (OWN, lo, n; distinct) with the digest of its words, by a join with the texts."""
    lists = cut(wanted.groupBy(*(F.col(k).alias(f"__{k}") for k in OWN)).agg(F.collect_list("lo").alias("__lo"), F.collect_list("n").alias("__n")))
    rows = join_checked(texts, lists, KEY, F.size("__lo") * 8 + 56, "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            raw, offsets = text_buffers(batch.column("__text"))
            words = Words(raw, offsets)
            counts = np.diff(batch.column("__lo").offsets.to_numpy())
            lo, n = (ints(batch.column(k).flatten()) for k in ("__lo", "__n"))
            doc = np.repeat(np.arange(batch.num_rows), counts)
            at = words.first[doc] + lo
            start, end = words.starts[at], words.ends[at + n - 1]
            # bytes.split() cuts at exactly the characters between words
            marks = [hashlib.blake2b(b" ".join(raw[a:b].tobytes().split()), digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist())]
            own = blobs.take(keys(batch), doc) | {"lo": lo.astype(np.int32), "n": n.astype(np.int32)}
            yield pa.RecordBatch.from_arrays([*map(pa.array, own.values()), pa.array(marks, pa.binary())], names=[*own, "digest"])

    return map_arrow(rows, run, f"{_SPAN_SCHEMA}, digest binary")


def compared(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The spans of found (fields of COPY) with same: whether their words equal those at their source coordinates. A source that many share is read once. Cut."""
    own, source = found.select(*OWN, "lo", "n"), found.select(*(F.col(s).alias(k) for k, s in zip(OWN, SOURCE)), F.col("slo").alias("lo"), "n")
    read = cut(digests_of_spans(texts, own.union(source).distinct()).distinct())
    there = read.select(*(F.col(k).alias(s) for k, s in zip(OWN, SOURCE)), F.col("lo").alias("slo"), "n", F.col("digest").alias("expected"))
    both = found.join(read, [*OWN, "lo", "n"]).join(there, [*SOURCE, "slo", "n"])
    return cut(both.select(*COPY, (F.col("digest") == F.col("expected")).alias("same")))


def verified(texts: DataFrame, found: DataFrame, window: int = WINDOW) -> DataFrame:
    """KEY, lo, n of the paths (cut) whose words equal those at their source coordinates. A path with a collision in it is taken apart into its edges, and those that differ stay in their texts."""
    judged = compared(texts, found)
    good, bad = judged.where("same").drop("same"), judged.where("not same").drop("same")
    if not bad.isEmpty():
        step = F.explode(F.sequence(F.lit(0), F.col("n") - window)).alias("step")
        single = bad.select(*OWN, *SOURCE, "lo", "slo", step).select(*OWN, *SOURCE, (F.col("lo") + F.col("step")).alias("lo"), (F.col("slo") + F.col("step")).alias("slo"), F.lit(window).alias("n"))
        good = good.unionByName(compared(texts, cut(single.distinct())).where("same").drop("same"))
    return good.select(*(F.col(k).alias(f"__{k}") for k in OWN), "lo", "n")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = MINIMISER) -> DataFrame:
    """KEY, __spans: word spans of every document that are later occurrences; cut."""
    texts = docs.select(*row_key(docs, id_col, text_col))
    buckets = blobs.buckets_for(total_bytes(docs, text_col))
    judged = cut(judge_pieces(pieces(texts, buckets, window, k), buckets))
    branches = cut(spans.by_document(judged.where("kind = 1").drop("kind")))
    single = judge_edges(edges(texts, branches, buckets, window), buckets)
    found = cut(judged.where("kind = 0").drop("kind").unionByName(single))
    said = vertices(found)
    copies = cut(paths(found, said, unitigs(said), window))
    return cut(spans.from_rows(verified(texts, copies, window)))


def keep(text: bytes, flat: np.ndarray) -> tuple[int, int, str, str]:
    """Words, removed words, the kept words joined by one space, and their digest."""
    raw = np.frombuffer(text, np.uint8)
    words = Words(raw, np.array([0, len(raw)]))
    n = len(words.starts)
    stay = np.ones(n, bool)
    for a, b in flat.reshape(-1, 2):
        stay[a:b] = False
    kept = b" ".join([text[a:b] for a, b in zip(words.starts[stay].tolist(), words.ends[stay].tolist())])
    return n, n - int(stay.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed, kept (the text that stays), kept_sha256 of every document."""
    rows = spans.with_spans(docs, repeated(docs, id_col, text_col, window), id_col, text_col)
    fields = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())]
    return spans.apply_spans(rows, keep, fields, "n_words long, n_removed long, kept string, kept_sha256 string").withColumnRenamed("doc", id_col)


def digests(docs: DataFrame) -> DataFrame:
    rows = spans.with_spans(docs, repeated(docs), "doc_id", "text")

    def each(text: bytes, flat: np.ndarray) -> tuple[int, int, str]:
        n, removed, _, digest = keep(text, flat)
        return n, removed, digest

    fields = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    return spans.apply_spans(rows, each, fields, "n_words long, n_removed long, kept_sha256 string").withColumnRenamed("doc", "doc_id")
