"""N-gram Jaccard join: documents whose sets of 5-word shingles overlap by 0.8 or more.

1. Every text becomes a set of hashed shingles; equal sets are one class (no pairs of
   copies are made).
2. A necessary condition drops most texts early. A linked text shares at least
   ceil(0.8 n) of its n shingles with its partner, so at most n - ceil(0.8 n) of them
   may be its own; the same bound holds for any subset of its shingles, and it is
   applied to those with a small hash (the same subset in every text).
3. For the classes left, exact document frequencies order each set rare first. Its
   prefix has n - ceil(0.8 n) + 1 shingles; those that no other set holds come first
   and need no join. Sets are renumbered to the positions of shared shingles.
   A shingle that more than HOT sets hold is counted by batches and numbered from a
   table that every task has, so no task gathers its holders.
4. Prefix shingles are joined under length and positional filters; a pair is checked by
   a suffix filter and then by the exact intersection, and pairs that have been checked
   are left out of later rounds, so each is verified once.
5. First come rounds of stars: each set is paired with one other that shares a prefix
   shingle, so large groups of near copies become one component from a linear number
   of pairs. The last round compares every pair that shares a prefix shingle and is
   not connected yet, at its first common shingle, so no link between components is
   lost.

Defined results: null texts and texts without words have an empty set and stand
alone; fewer than five words are one shingle; a null doc_id counts as the smallest;
repeated rows are copies; rows that share a doc_id but not the text are separate
nodes with one id; an empty table gives an empty one; other columns are not read.
Shingles are 64-bit hashes, and a set is known by the sum of its hashes, mixed, and its
size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import blobs
from framewright.llm.blobs import Columns
from framewright.llm.common import KEY, KEY_SCHEMA, NULL_ID, chunks, cut, ints, join_checked, keys, map_arrow, row_key, text_buffers, total_bytes
from framewright.llm.components import components
from framewright.llm.hashing import Prefixes, Words, mix

SHINGLE = 5
#: Similarity 0.8 as a fraction.
NUM, DEN = 4, 5
#: Share of the hash range in which a shingle takes part in step 2.
SAMPLED = 0.3
#: Rounds of stars before all remaining pairs are compared.
STARS = 4
#: Sets whose common shingle is gathered by one task; more common shingles go by a table of at most HOT_KEYS entries (16 bytes each), the most common ones.
HOT, HOT_KEYS = 1_000_000, 2 << 20

#: kind 0: a shingle; 1: one that recurs in its batch; 2: a count of shared shingles; 3: a document's set (a: its hash, n: size, s: sampled shingles).
SHARED = {"=a": "<u8"} | blobs.OWNER | {"n": "<i4", "s": "<i4", "kind": "u1"}
#: A shingle of a set.
HELD = {"=a": "<u8", "node": "<i8", "n": "<i4"}
#: A shingle of several sets: its number, its frequency.
RANKED = {"node": "<i8", "n": "<i4", "t": "<i8", "df": "<i4"}
NUMBERS = {"t": "<i8"}


def least_overlap(n: np.ndarray) -> np.ndarray:
    """ceil(0.8 n)."""
    return (NUM * n + DEN - 1) // DEN


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle hash) of a batch, sorted and distinct."""
    words = Words(raw, offsets, lower=True)
    hashes = words.hashes()
    count = np.diff(words.first)
    grams = Prefixes(hashes).grams(SHINGLE)
    whole = np.arange(SHINGLE, SHINGLE + len(grams)) <= np.repeat(words.first[1:], count)[: len(grams)]
    doc = np.repeat(np.arange(len(count)), count)[: len(grams)][whole]
    grams = grams[whole]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        sums = Prefixes(hashes)
        one = mix(sums.ranges(words.first[short], words.first[short + 1]) ^ mix(count[short].astype(np.uint64)))
        doc, grams = np.concatenate((doc, short)), np.concatenate((grams, one))
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(doc) != 0) | (grams[1:] != grams[:-1])
    return doc[new], grams[new]


def bucket_of(a: np.ndarray, buckets: int) -> np.ndarray:
    return ((a >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)


def id_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(mix(ids.view(np.uint64)), buckets)


def _per_document(c: Columns) -> tuple[np.ndarray, np.ndarray]:
    """Order by document and group starts."""
    order, group = blobs.groups(*blobs.owner(c))
    return order, np.flatnonzero(np.diff(group, prepend=-1))


def _counts(c: Columns) -> Columns:
    """Kind-2 records: how many of the given shingles each document has."""
    order, cuts = _per_document(c)
    n = np.diff(np.append(cuts, len(order)))
    own = blobs.take(c, order[cuts])
    zero = np.zeros(len(cuts), np.int32)
    return own | {"a": zero.astype(np.uint64), "n": n.astype(np.int32), "s": zero, "kind": np.full(len(cuts), 2, np.uint8)}


def _recurring(c: Columns, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each shingle record belongs to several documents (weight: 2 where that is known already), and whether it is the first of its shingle."""
    order, group = blobs.groups(c["a"], *blobs.owner(c))
    _, own = blobs.groups(c["a"])
    new = np.diff(group, prepend=-1) != 0
    total = np.bincount(own, new * weight[order]) if len(own) else np.empty(0)
    again, first = np.zeros(len(order), bool), np.zeros(len(order), bool)
    again[order] = total[own] > 1 if len(own) else again
    first[order] = np.diff(own, prepend=-1) != 0
    return again, first


def sampled(texts: DataFrame, buckets: int) -> DataFrame:
    """bucket, blob of SHARED records of all texts."""
    limit = np.uint64(int(SAMPLED * 2**64))

    def combine(parts: list[Columns], sets: list[Columns]) -> pa.RecordBatch:
        c = blobs.concat(parts)
        again, first = _recurring(c, np.ones(len(c["a"]), np.int64))
        zero = np.zeros(len(c["a"]), np.int32)
        c |= {"n": zero, "s": zero, "kind": again.astype(np.uint8)}
        out = blobs.concat([blobs.take(c, ~again | first), _counts(blobs.take(c, again)), *sets])
        bucket = np.where(out["kind"] < 2, bucket_of(out["a"], buckets), id_bucket(out["id"], buckets))
        return blobs.batch_of(*blobs.scatter(out, bucket, SHARED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Columns] = []
        sets: list[Columns] = []
        size = 0
        for batch in chunks(batches):
            ids = keys(batch)
            doc, grams = shingle_sets(*text_buffers(batch.column("__text")))
            n = np.bincount(doc, minlength=batch.num_rows)
            low = grams < limit
            sums = np.zeros(batch.num_rows, np.uint64)
            np.add.at(sums, doc, mix(grams))
            key = mix(sums + n.astype(np.uint64))
            s = np.bincount(doc[low], minlength=batch.num_rows)
            sets.append({"a": key, **ids, "n": n.astype(np.int32), "s": s.astype(np.int32), "kind": np.full(batch.num_rows, 3, np.uint8)})
            own = doc[low]
            parts.append({"a": grams[low], **blobs.take(ids, own)})
            size += len(own) + batch.num_rows
            if size >= blobs.GATHER:
                yield combine(parts, sets)
                parts, sets, size = [], [], 0
        if size:
            yield combine(parts, sets)

    return map_arrow(texts, run, "bucket long, blob binary")


def shared_counts(packed: DataFrame, buckets: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], SHARED)
        live = blobs.take(c, c["kind"] < 2)
        again, _ = _recurring(live, 1 + live["kind"].astype(np.int64))
        # a shingle that recurs in its batch has been counted there
        out = blobs.concat([blobs.take(c, c["kind"] >= 2), _counts(blobs.take(live, again & (live["kind"] == 0)))])
        out = blobs.take(out, np.argsort(out["id"], kind="stable"))
        numbers, rows = blobs.scatter(out, id_bucket(out["id"], buckets), SHARED)
        return pd.DataFrame({"bucket": numbers, "blob": rows})

    return packed.groupBy("bucket").applyInPandas(run, "bucket long, blob binary")


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """KEY, key (hash of the set), n (its size), open (whether it may have a partner) of every distinct document; cut."""
    texts = docs.select(*row_key(docs, id_col, text_col))
    buckets = blobs.buckets_for(total_bytes(docs, text_col))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], SHARED)
        order, cuts = _per_document(c)
        c = blobs.take(c, order)
        shared = np.add.reduceat(np.where(c["kind"] == 2, c["n"], 0), cuts) if len(cuts) else np.empty(0, np.int64)
        whole = c["kind"] == 3
        which = np.searchsorted(cuts, np.flatnonzero(whole), "right") - 1
        keep = np.unique(which, return_index=True)[1]  # repeated rows
        own = blobs.take(c, np.flatnonzero(whole)[keep])
        n, s = own["n"].astype(np.int64), own["s"].astype(np.int64)
        may = (n > 0) & (shared[which[keep]] >= s - (n - least_overlap(n)))
        return pd.DataFrame({f"__{k}": own[k] for k in blobs.OWNER} | {"key": own["a"].view(np.int64), "n": own["n"], "open": may})

    counted = shared_counts(sampled(texts, buckets), buckets)
    return cut(counted.groupBy("bucket").applyInPandas(run, f"{KEY_SCHEMA}, key long, n int, open boolean"))


def ranked_sets(docs: DataFrame, sets: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The open classes (node, key, n), and of those with a shared prefix: node, n, shared (numbers of its shared shingles, packed), prefix (the shared ones of its prefix, rare first), at (place of the first of them). Both cut."""
    one = sets.where("open").groupBy("key", "n").agg(F.min(F.struct(*KEY)).alias("d"))
    nodes = cut(cut(one.select("key", "n", "d.*")).withColumn("node", F.monotonically_increasing_id()))
    texts = docs.select(*row_key(docs, id_col, text_col))
    rows = join_checked(texts, nodes.select("node", *KEY), KEY, F.lit(48), "inner")
    buckets = blobs.buckets_for(total_bytes(docs, text_col))

    # no shingle can have more holders than there are sets
    hot, hot_df = common_shingles(rows, buckets) if nodes.count() > HOT else (np.empty(0, np.uint64), np.empty(0, np.int32))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Columns] = []
        size = 0

        def flush() -> pa.RecordBatch:
            c = blobs.concat(parts)
            c = blobs.take(c, np.argsort(c["node"], kind="stable"))
            at = np.minimum(np.searchsorted(hot, c["a"]), max(len(hot) - 1, 0))
            known = hot[at] == c["a"] if len(hot) else np.zeros(len(c["a"]), bool)
            own, rest = blobs.take(c, known), blobs.take(c, ~known)
            own = {"node": own["node"], "n": own["n"], "t": (1 << 62) + at[known], "df": hot_df[at[known]]}
            sent = [blobs.scatter(own, id_bucket(own["node"], buckets), RANKED), blobs.scatter(rest, bucket_of(rest["a"], buckets), HELD)]
            kinds = [kind for kind, (numbers, _) in zip((1, 0), sent) for _ in numbers]
            columns = [pa.array([x for s in sent for x in s[k]], kind) for k, kind in ((0, pa.int64()), (1, pa.binary()))]
            return pa.RecordBatch.from_arrays([columns[0], pa.array(kinds, pa.int32()), columns[1]], names=["bucket", "kind", "blob"])

        for batch in chunks(batches):
            doc, grams = shingle_sets(*text_buffers(batch.column("__text")))
            n = np.bincount(doc, minlength=batch.num_rows).astype(np.int32)
            parts.append({"a": grams, "node": ints(batch.column("node"))[doc], "n": n[doc]})
            size += len(doc)
            if size >= blobs.GATHER:
                yield flush()
                parts, size = [], 0
        if size:
            yield flush()

    def frequencies(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iloc[0] == 1:
            return pdf[["bucket", "blob"]]
        c = blobs.unpack(pdf["blob"], HELD)
        order, pair = blobs.groups(c["a"], c["node"])
        order = order[np.diff(pair, prepend=-1) != 0]  # repeated rows
        c = blobs.take(c, order)
        _, own = blobs.groups(c["a"])
        df = np.bincount(own)[own] if len(own) else own
        several = df > 1
        number = (int(pdf["bucket"].iloc[0]) << 36) + own
        out = {"node": c["node"][several], "n": c["n"][several], "t": number[several], "df": df[several].astype(np.int32)}
        out = blobs.take(out, np.lexsort((out["t"], out["node"])))
        numbers, packed = blobs.scatter(out, id_bucket(out["node"], buckets), RANKED)
        return pd.DataFrame({"bucket": numbers, "blob": packed})

    def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], RANKED)
        order, same = blobs.groups(c["node"], c["df"], c["t"])
        c = blobs.take(c, order[np.diff(same, prepend=-1) != 0])  # repeated rows
        cuts = np.append(np.flatnonzero(np.diff(c["node"], prepend=c["node"][:1] - 1)), len(c["node"]))
        rows = []
        for a, b in zip(cuts, cuts[1:]):
            n = int(c["n"][a])
            alone = n - (b - a)
            prefix = n - int(least_overlap(np.int64(n))) + 1
            if prefix > alone:
                rows.append((int(c["node"][a]), n, blobs.pack({"t": np.sort(c["t"][a:b])}, NUMBERS), c["t"][a : a + prefix - alone], alone))
        return pd.DataFrame(rows, columns=["node", "n", "shared", "prefix", "at"])

    packed = map_arrow(rows, held, "bucket long, kind int, blob binary").groupBy("kind", "bucket").applyInPandas(frequencies, "bucket long, blob binary")
    ranked = packed.groupBy("bucket").applyInPandas(ordered, "node long, n int, shared binary, prefix array<long>, at int")
    return nodes, cut(ranked)


def common_shingles(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles (sorted) that more than HOT sets hold, or the HOT_KEYS most common of them, and their numbers of holders. Counts are combined in the mappers, so a hot shingle costs a record a batch."""
    fields = {"=a": "<u8", "c": "<i4"}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            a, c = np.unique(np.concatenate(parts), return_counts=True)
            return blobs.batch_of(*blobs.scatter({"a": a, "c": c.astype(np.int32)}, bucket_of(a, buckets), fields))

        for batch in chunks(batches):
            parts.append(shingle_sets(*text_buffers(batch.column("__text")))[1])
            size += len(parts[-1])
            if size >= blobs.GATHER:
                yield flush()
                parts, size = [], 0
        if size:
            yield flush()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        c = blobs.unpack(pdf["blob"], fields)
        a, own = np.unique(c["a"], return_inverse=True)
        total = np.bincount(own, c["c"]).astype(np.int64)
        return pd.DataFrame({"a": a[total > HOT].view(np.int64), "c": total[total > HOT]})

    found = map_arrow(rows.select("__text"), count, "bucket long, blob binary").groupBy("bucket").applyInPandas(add, "a long, c long")
    top = found.orderBy(F.col("c").desc(), "a").limit(HOT_KEYS).toPandas()
    a, c = top["a"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    order = np.argsort(a)
    return a[order], np.minimum(c[order], np.iinfo(np.int32).max).astype(np.int32)


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int = 2) -> int:
    """An upper bound of the intersection of two sorted sets: halves are compared with where they fall in the other set."""
    if not depth or len(x) < 2 or len(y) < 2:
        return min(len(x), len(y))
    middle = len(x) // 2
    at = int(np.searchsorted(y, x[middle]))
    return suffix_bound(x[:middle], y[:at], depth - 1) + suffix_bound(x[middle:], y[at:], depth - 1)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v; cut) whose sets overlap enough; each is checked once, where its two sets meet. Only the sets of pairs travel if the pairs themselves are few enough to be sent out."""
    left = sets.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("shared").alias("su"))
    right = sets.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("shared").alias("sv"))
    rows = join_checked(left, pairs, ["u"], F.lit(32), "inner").join(join_checked(right, pairs, ["v"], F.lit(32), "inner"), ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for nu, su, nv, sv in zip(*(batch.column(c).to_pylist() for c in ("nu", "su", "nv", "sv"))):
                x, y = blobs.unpack([su], NUMBERS)["t"], blobs.unpack([sv], NUMBERS)["t"]
                need = -(-NUM * (nu + nv) // (NUM + DEN))
                keep.append(suffix_bound(x, y) >= need and len(np.intersect1d(x, y, assume_unique=True)) >= need)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(rows, run, "u long, v long")


def _possible(na: str, nb: str, aa: str, ab: str, pa_: str, pb: str):
    """Length and positional filters for two sets that share a shingle at places pa_ and pb of their rare-first orders, the first aa and ab of which no other set holds."""
    x, y, i, j = F.col(na), F.col(nb), F.col(pa_), F.col(pb)
    length = F.least(x, y) * DEN >= F.greatest(x, y) * NUM
    most = F.least(i - F.col(aa), j - F.col(ab)) + 1 + F.least(x - i - 1, y - j - 1)
    return length & (most * (NUM + DEN) >= (x + y) * NUM)


def links(sets: DataFrame) -> DataFrame:
    """node, root of the nodes that have links; sets as from ranked_sets. Cut."""
    postings = sets.select("node", "n", "at", "prefix", F.posexplode("prefix").alias("i", "t"))
    postings = postings.select("node", "n", "at", "t", (F.col("at") + F.col("i")).alias("p"), F.slice("prefix", F.lit(1), F.col("i")).alias("before"))
    roots = checked = None
    for turn in range(STARS + 1):
        # without a root yet, every node is its own component
        here = postings if turn == STARS else postings.drop("before")
        here = here.withColumn("root", F.col("node")) if roots is None else join_checked(here, roots, ["node"], F.lit(32)).withColumn("root", F.coalesce("root", "node"))
        several = cut(here.groupBy("t").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("t"))
        here = join_checked(here, several, ["t"], F.lit(24), "inner")
        pairs = _starred(here, turn) if turn < STARS else _remaining(here)
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        pairs = cut(pairs if checked is None else join_checked(pairs, checked, ["u", "v"], F.lit(24), "left_anti"))
        checked = pairs if checked is None else checked.unionByName(pairs)
        new = cut(linked(pairs, sets))
        if roots is not None:
            if new.isEmpty():
                continue
            new = new.union(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
        roots = cut(components(new))
    return roots


def _starred(here: DataFrame, turn: int) -> DataFrame:
    """Every node takes one of its shingles, the same for all that may take it, and is paired with one node of that shingle: the one with the smallest share of shingles of its own, or in odd turns any. At most one pair a node."""
    one = here.groupBy("node").agg(F.min_by(F.struct("t", "n", "at", "root"), F.xxhash64("t", F.lit(turn))).alias("x")).select("node", "x.*")
    order = F.struct(F.col("at") / F.col("n"), F.col("node")) if turn % 2 == 0 else F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"))
    hub = one.groupBy("t").agg(F.min_by(F.struct(F.col("node").alias("v"), F.col("n").alias("m"), F.col("root").alias("other")), order).alias("h")).select("t", "h.*")
    near = (F.col("root") != F.col("other")) & (F.least("n", "m") * DEN >= F.greatest("n", "m") * NUM)
    return one.join(hub, "t").where(near).withColumnRenamed("node", "u")


def _remaining(here: DataFrame) -> DataFrame:
    """Every pair of nodes of different components that shares a prefix shingle and passes the filters, found at its first common shingle only, so once."""
    other = here.select("t", *(F.col(a).alias(b) for a, b in (("node", "v"), ("n", "m"), ("at", "bt"), ("p", "q"), ("root", "other"), ("before", "prior"))))
    first = ~F.arrays_overlap("before", "prior")
    return here.withColumnRenamed("node", "u").join(other, (here["t"] == other["t"]) & (F.col("root") < F.col("other")) & _possible("n", "m", "at", "bt", "p", "q") & first).select("u", "v")


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """KEY, n_shingles, joint (the least KEY reachable; __id is NULL_ID for null) of every distinct document."""
    sets = document_sets(docs, id_col, text_col)
    nodes, ranked = ranked_sets(docs, sets, id_col, text_col)
    roots = links(ranked)
    # the least document of each class, then of each component
    classes = sets.where("n > 0").groupBy("key", "n").agg(F.min(F.struct(*KEY)).alias("least"))
    placed = nodes.select("key", "n", "node").join(roots, "node")
    classes = cut(classes.join(placed.select("key", "n", "root"), ["key", "n"], "left"))
    joint = classes.where("root is not null").groupBy("root").agg(F.min("least").alias("joint"))
    classes = classes.join(joint, "root", "left").select("key", "n", F.coalesce("joint", "least").alias("joint"))
    own = F.struct(*KEY)
    return sets.join(classes, ["key", "n"], "left").select(*KEY, F.col("n").cast("long").alias("n_shingles"), F.coalesce("joint", own).alias("joint"))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id of every row (repeated rows repeat)."""
    found = cluster(docs, id_col, text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), *row_key(docs, id_col, text_col)).drop("__text")
    out = rows.join(found, KEY).select("doc", "n_shingles", F.when(F.col("joint.__id") != NULL_ID, F.col("joint.__id")).alias("component_id"))
    return out.withColumnRenamed("doc", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows of a component other than one of its least document, with all their columns, whatever their names; rows without words all stay. The documents that go are broadcast only if their measured size allows it."""
    found = cluster(docs, id_col, text_col)
    gone = cut(found.where(F.col("joint") != F.struct(*KEY)).select(*KEY))
    # the row stands apart from the key, so none of its columns can clash
    key = row_key(docs, id_col, text_col)
    rows = docs.select(*key[:3], F.coalesce(F.col(f"`{text_col}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("__worded"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    again = cut(rows.where("__worded").groupBy(*KEY).count().where("count > 1").select(*KEY))
    rows = join_checked(rows, gone, KEY, F.lit(32), "left_anti")
    if not again.isEmpty():
        single = join_checked(rows, again, KEY, F.lit(32), "left_anti").select("__row")
        # whole texts are compared, and copies are combined before the shuffle
        several = join_checked(rows, again, KEY, F.lit(32), "left_semi").withColumn("__text", F.col("__row").getField(text_col))
        rows = single.unionByName(several.groupBy(*KEY, "__text").agg(F.min_by("__row", F.to_json("__row")).alias("__row")).select("__row"))
    return rows.select("__row.*")
