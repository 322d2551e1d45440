"""Search for the patterns of a table in texts: an equi-join on one seed of each pattern, then a comparison in place.

The plan's size does not depend on how many patterns there are. A seed is a stretch of a pattern of 1, 2, 4, 8 or
SEED characters, the longest that fits, named by a 64-bit hash; of its stretches the one that is rarest in the texts
serves, so frequent ones bring few candidates. Windows of texts travel only if a bit filter over the seeds has their
hash: it loses none, and what it lets through beyond the seeds the join drops. A seed that many windows share is split
by adaptive execution, as both sides of the join are shuffled; small dictionaries are broadcast instead, up to a checked
number of patterns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from readloom.sources.staging import materialize

SEED = 16
SIZES = (1, 2, 4, 8, SEED)
#: Patterns that are broadcast, at most, and the length of a broadcast pattern.
BROADCAST_PATTERNS, BROADCAST_LENGTH = 100_000, 1000
#: Bits of the filter, as a power of two: about 16 a seed between these.
LEAST_BITS, MOST_BITS = 12, 28
#: Characters whose windows are made together, about.
GROUP_CHARACTERS = 500_000
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9))


def _windows(texts: list[str], sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, numbers of the texts, places, hashes) of all windows of each size; sizes are powers of two, in order."""
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    h = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = np.cumsum(length)
    owner = np.repeat(np.arange(len(texts)), length)
    at, left = np.arange(len(h)) - (end - length)[owner], end[owner] - np.arange(len(h))
    size = 1
    while sizes:
        if size == sizes[0]:
            whole = np.flatnonzero(left[: len(h)] >= size)
            yield size, owner[whole], at[whole], h[whole].view(np.int64)
            sizes = sizes[1:]
        h = h[: max(0, len(h) - size)] * _FACTORS[0] + h[size:]
        h = (h ^ (h >> np.uint64(29))) * _FACTORS[2]
        size *= 2


def _groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) of groups of about GROUP_CHARACTERS."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP_CHARACTERS:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, texts[first:]


def _places(h: np.ndarray, factor: np.uint64, bits: int) -> np.ndarray:
    return (h.view(np.uint64) * factor) >> np.uint64(64 - bits)


def _held(words: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Numbers of the places whose bit is set."""
    bit = words[(p >> np.uint64(6)).view(np.int64)].view(np.uint64) >> (p & np.uint64(63))
    return np.flatnonzero(bit & np.uint64(1))


def bit_filter(seeds: DataFrame, n: int) -> tuple[Broadcast, int]:
    """Words of a bit filter over the column `seed` of about n rows, two bits a seed, and its size as a power of two.

    Its words are put together by Spark; at most 2 ** MOST_BITS bits reach the driver, whatever the rows. A fuller filter
    lets more windows through, and loses none.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.unique(np.concatenate([_places(b.column(0).to_numpy(), f, bits) for f in _FACTORS[:2]]))
            word, first = np.unique(p >> np.uint64(6), return_index=True)
            bit = np.uint64(1) << (p & np.uint64(63))
            found = np.bitwise_or.reduceat(bit, first) if len(p) else bit
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(found.view(np.int64))], names=["word", "bits"])

    table = seeds.select("seed").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return seeds.sparkSession.sparkContext.broadcast(out), bits


def windows(texts: DataFrame, text: str, sizes: list[int], kept: tuple[Broadcast, int] | None = None) -> DataFrame:
    """(columns of texts, at, seed): all windows of the sizes, or those whose hash a bit filter may have."""
    columns, place = texts.columns, texts.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, group in _groups(b.column(place).to_pylist()):
                for _, owner, at, h in _windows(group, sizes):
                    if kept is not None:
                        for factor in _FACTORS[:2]:
                            met = _held(kept[0].value, _places(h, factor, kept[1]))
                            owner, at, h = owner[met], at[met], h[met]
                    rows = b.take(pa.array(owner + first))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(at.astype(np.int32)), pa.array(h)], names=[*columns, "at", "seed"])

    fields = [*texts.schema.fields, StructField("at", IntegerType()), StructField("seed", LongType())]
    return texts.mapInArrow(run, StructType(fields))


def _stretches(patterns: DataFrame, sizes: list[int]) -> DataFrame:
    """(pattern, size, at, seed): every stretch of each pattern of its own size."""
    each = [windows(patterns.filter(F.col("size") == s), "pattern", [s]) for s in sizes]
    out = each[0]
    for more in each[1:]:
        out = out.union(more)
    return out


def seeded(texts: DataFrame, patterns: DataFrame, sizes: list[int]) -> DataFrame:
    """(pattern, at, seed): each pattern with its stretch that occurs least in texts (_t), the first of equal ones.

    patterns: distinct `pattern`, and `size`, the length of their seeds.
    """
    own = materialize(_stretches(patterns, sizes), "stretches")
    seen = windows(texts.select("_t"), "_t", sizes, bit_filter(own, own.count())).groupBy("seed").agg(F.count("*").alias("n"))
    counted = own.join(seen, "seed", "left")
    best = F.min_by(F.struct("at", "seed"), F.struct(F.coalesce("n", F.lit(0)), "at")).alias("b")
    return counted.groupBy("pattern").agg(best).select("pattern", "b.at", "b.seed")


def search_dictionary(texts: DataFrame, patterns: DataFrame, key: str, text: str, pattern: str = "pattern", most: int = BROADCAST_PATTERNS) -> DataFrame:
    """(key, pattern, start): every place, from 0, of every pattern in the column `text`, in any letter case, overlaps
    included.

    key names a text once. Patterns come back in lower case, repeated ones once; null and empty patterns and null texts
    find nothing. most: patterns up to which the dictionary is broadcast.
    """
    known = patterns.select(F.lower(F.col(pattern)).alias("pattern")).filter("length(pattern) > 0").distinct()
    size = F.greatest(*[F.when(F.length("pattern") >= s, s).otherwise(1) for s in SIZES])
    known = materialize(known.withColumn("size", size), "patterns")
    n, longest = known.agg(F.count("*"), F.max(F.length("pattern"))).first()
    sizes = sorted(r[0] for r in known.select("size").distinct().collect()) or [1]
    small = n <= most and (longest or 0) <= BROADCAST_LENGTH
    rows = texts.select(F.col(key).alias("_key"), F.lower(F.col(text)).alias("_t")).filter("_t is not null")
    seeds = materialize(seeded(rows, known, sizes), "seeds").select("pattern", F.col("at").alias("_at"), F.col("seed").alias("_seed"))
    met = windows(rows, "_t", sizes, bit_filter(seeds.select(F.col("_seed").alias("seed")), n))
    begins = (F.col("at") - F.col("_at")).alias("start")
    if small:
        # The text is at hand in its row.
        met = met.join(F.broadcast(seeds), F.col("seed") == F.col("_seed")).select("_key", "_t", "pattern", begins)
    else:
        # Windows travel without their text, which comes back for candidates alone.
        met = met.select("_key", "at", "seed").join(seeds, F.col("seed") == F.col("_seed")).select("_key", "pattern", begins)
        held = rows.select(F.col("_key").alias("_k"), "_t")
        met = met.join(held, F.col("_key") == F.col("_k"))
    found = met.filter("start >= 0 and substr(_t, start + 1, length(pattern)) = pattern")
    return found.select(F.col("_key").alias(key), "pattern", "start")
