"""Exact verification of candidate clusters of word sets, in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import parts

#: Members of a cluster that a task compares with as many others.
BLOCK = 512


def jaccard_links(members: DataFrame, similarity: float = 0.8, block: int = BLOCK, nodes: DataFrame | None = None) -> DataFrame:
    """(cluster, node, grams) -> links (a, b) spanning all pairs of a cluster with set similarity >= `similarity`.

    nodes: a frame with the column `cluster` of the same members, if one is at hand that is cheaper to count.

    grams are distinct unsigned 64-bit hashes as bytes, nodes are distinct. Clusters over `block` members are cut into
    blocks by the node's hash and every pair of blocks is compared in a task of its own, so that none is held whole.
    A row is compared with the rows of a linked group until one suits, so a group of copies takes one comparison a row;
    components are those of all the links.
    """
    sizes = (nodes or members).groupBy("cluster").agg(F.count("*").alias("_n")).filter("_n > 1")
    sizes = sizes.select(F.col("cluster").alias("_c"), F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    dealt = members.join(sizes, F.col("cluster") == F.col("_c")).withColumn("i", F.pmod(F.xxhash64("node"), "_blocks").cast("int"))
    dealt = dealt.withColumn("o", F.explode_outer(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.select("cluster", F.least("i", "o").alias("lo"), F.greatest("i", "o").alias("hi"), "i", "node", "grams")
    dealt = dealt.repartition(parts(members.sparkSession), "cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")

    def compare(rows: list[tuple[int, int, bytes]], crossed: bool) -> Iterator[tuple[int, int]]:
        sets = [set(np.frombuffer(g, np.uint64).tolist()) for _, _, g in rows]
        order = sorted(range(len(rows)), key=lambda k: len(sets[k]))
        joined: list[list[int]] = []  # places in `order`, ascending, of rows linked so far
        for n, y in enumerate(order):
            b, own, alone = sets[y], [n], []
            for group in joined:
                for m in reversed(group):
                    a = sets[order[m]]
                    if len(a) < similarity * len(b):
                        alone.append(group)
                        break
                    if crossed and rows[order[m]][0] == rows[y][0]:
                        continue
                    both = len(a & b)
                    if both >= similarity * (len(a) + len(b) - both) - 1e-9:
                        own += group
                        yield rows[order[m]][1], rows[y][1]
                        break
                else:
                    alone.append(group)
            joined = [*alone, sorted(own)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, found = None, [], []
        for batch in batches:
            for c, lo, hi, i, node, grams in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if (c, lo, hi) != key:
                    if len(rows) > 1:
                        found += compare(rows, key[1] != key[2])
                    key, rows = (c, lo, hi), []
                rows.append((i, node, grams))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])
                found = []
        if len(rows) > 1:
            found = list(compare(rows, key[1] != key[2]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")
