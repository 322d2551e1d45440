"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import materialize

#: Links (8 MB of them) that one task settles by itself; more are contracted in rounds.
FEW_LINKS = 1 << 19


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, least node reached) of all links of a task, the least nodes themselves included."""
    ends = [np.column_stack([c.to_numpy() for c in b.columns]) for b in batches]
    if not ends:
        return
    ids, places = np.unique(np.concatenate(ends), return_inverse=True)
    root = list(range(len(ids)))
    for a, b in places.reshape(-1, 2).tolist():
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        root[max(a, b)] = min(a, b)
    to = np.array(root)
    while (to != to[to]).any():
        to = to[to]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[to])], names=["node", "component"])


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links of long node ids -> (node, component), component being the smallest node id reached.

    Nodes without a link do not appear; null ends, self links and repeated links are ignored. An empty input
    gives an empty result. A round finds each node's least neighbour by an aggregation that combines before its
    shuffle, and joins it back to the links by a key that Spark deals anew, so that it can split the link list of a hub:
    no task needs it whole. A round is written to the shared folder, so a lost executor repeats one at most. Rounds go on
    until nothing changes, or no more than FEW_LINKS links are left, which one task settles; their number grows with the
    logarithm of the longest chain. Few links are written as they come, with no shuffle of theirs.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    edges = materialize(edges, "links")
    state = _state(edges)
    if state[0] > FEW_LINKS:
        edges = materialize(edges.distinct(), "links")
        state = _state(edges)
    while state[0] > FEW_LINKS:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select(_dealt_anew("u").alias("w"), F.least("u", "m").alias("m"))
        large = edges.join(nearest, _dealt_anew("v") == nearest.w).select("u", F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(_dealt_anew("u").alias("w"), "m")
        small = large.join(least, _dealt_anew("u") == least.w).select("u", "v", "m")
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e")
        small = small.select(ends).select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).filter("u <> v")
        edges = materialize(small.distinct(), "stars")
        before, state = state, _state(edges)
        if before == state:
            break
    if state[0] <= FEW_LINKS:
        return materialize(edges.coalesce(1).mapInArrow(_settled, "node long, component long"), "stars")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _dealt_anew(node: str) -> F.Column:
    """A node under another name, by which neither side of a join lies dealt out already: adaptive execution splits hot
    keys only where both sides are shuffled for the join."""
    return F.col(node).bitwiseXOR(F.lit(1).cast("long"))


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum of the edges."""
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(v, u) % 1000003)")).first()
    return tuple(row)
