"""Connected components of a graph given by its edges.

A graph of at most SMALL edges, counted first, is solved by union-find inside one task
(its memory is bounded by that constant). Larger graphs go through alternating large and
small stars, entirely in DataFrames, in rounds that grow with the logarithm of the
longest chain. Nothing is collected to the driver in either case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import cut, map_arrow

#: Edges that one task may hold: 16 bytes each.
SMALL = 1_000_000


def components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """node, root (the least node reachable) of every node of edges (u, v: long); nulls and self-links are ignored."""
    pairs = cut(edges.select("u", "v").where("u != v"))
    return _in_one_task(pairs) if pairs.count() <= small else _by_stars(pairs)


def _in_one_task(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if parts:
            u, v = (np.concatenate(side) for side in zip(*parts))
            nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
            u, v = at[: len(u)], at[len(u) :]
            root = np.arange(len(nodes))
            while True:  # hooks roots to smaller ones, then halves all paths
                low = np.minimum(root[u], root[v])
                new = root.copy()
                np.minimum.at(new, root[u], low)
                np.minimum.at(new, root[v], low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            while (root[root] != root).any():
                root = root[root]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], names=["node", "root"])

    return map_arrow(pairs.coalesce(1), run, "node long, root long")


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour (the larger ones for a large star, the smaller ones for a small star) to the least of a node and its neighbours."""
    if large:
        both = pairs.union(pairs.select("v", "u"))
    else:
        both = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        linked = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return linked.where(F.col("u") != F.col("v")).distinct()


def _by_stars(pairs: DataFrame) -> DataFrame:
    before = None
    while True:
        pairs = cut(_star(_star(pairs, True), False))
        # the same count and the same sum of hashes mean that nothing moved
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    # every node hangs on its root now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(pairs.select("v", "v").distinct())
