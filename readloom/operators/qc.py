"""Quality-control tables of reads: by position, by length, by GC share, by mean quality, duplication levels, base
content, overrepresented sequences, adapters."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.sequences import phred


def per_position(reads: DataFrame) -> DataFrame:
    """(position, n, mean_q, median_q): Phred by position.

    Medians come from counts by score, so at most 94 rows a position and task are shuffled, whatever the reads.
    """
    each = reads.select(F.posexplode_outer(phred("quality")).alias("position", "q")).filter("position is not null")
    counts = each.groupBy("position", "q").agg(F.count("*").alias("n"))
    return counts.groupBy("position").agg(
        F.sum("n").alias("n"), (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean_q"), F.percentile("q", F.lit(0.5), F.col("n")).alias("median_q")
    )


def histogram(reads: DataFrame, value: F.Column, name: str) -> DataFrame:
    return reads.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def length_histogram(reads: DataFrame) -> DataFrame:
    return histogram(reads, F.length("sequence"), "length")


def gc_histogram(reads: DataFrame) -> DataFrame:
    """By whole per cent of GC."""
    gc = F.length("sequence") - F.length(F.translate("sequence", "CG", ""))
    return histogram(reads.filter(F.length("sequence") > 0), F.floor(gc * 100 / F.length("sequence")), "gc_percent")


def quality_histogram(reads: DataFrame) -> DataFrame:
    """By whole mean Phred score; needs Q_Score."""
    return histogram(reads, F.floor("Q_Score"), "mean_q")


def duplication_levels(reads: DataFrame) -> DataFrame:
    """(copies, n_sequences): how many distinct sequences occur so often."""
    each = reads.groupBy(F.xxhash64("sequence").alias("h"), "sequence").agg(F.count("*").alias("copies"))
    return each.groupBy("copies").agg(F.count("*").alias("n_sequences"))


BASES = "ACGT"


def base_content(reads: DataFrame) -> DataFrame:
    """(position, n, A, C, G, T, other): shares of the bases at each position, in any letter case."""
    each = reads.select(F.posexplode(F.split(F.upper("sequence"), "")).alias("position", "base"))
    counts = each.filter("base <> ''").groupBy("position").agg(F.count("*").alias("n"), *[F.count_if(F.col("base") == b).alias(b) for b in BASES])
    shares = [(F.col(b) / F.col("n")).alias(b) for b in BASES]
    return counts.select("position", "n", *shares, ((F.col("n") - sum(F.col(b) for b in BASES)) / F.col("n")).alias("other"))


def _frequent(capacity: int):
    """Rows (sequence, least): of a task's sequences up to `capacity`, with counts that fall short of the true ones by
    the task's rows / (capacity + 1) at most; a sequence left out occurs so often at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for b in batches:
            held.update(b.column(0).to_pylist())
            if len(held) > capacity:
                cut = sorted(held.values(), reverse=True)[capacity]
                held = Counter({s: n - cut for s, n in held.items() if n > cut})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["sequence", "least"])

    return run


def overrepresented(reads: DataFrame, share: float = 0.001, length: int | None = None) -> DataFrame:
    """(sequence, n, share): the sequences, or their first `length` bases, that make up at least `share` of all reads.

    A first pass keeps 2 / share candidates a task in a summary that can be added up; what may reach the share, 2 / share
    sequences at most, is counted exactly in a second pass. Distinct sequences are never shuffled. Null ones are ignored.
    """
    if not 0 < share <= 1:
        raise ValueError("share: above 0, up to 1")
    bases = F.col("sequence") if length is None else F.substring("sequence", 1, length)
    rows = reads.filter("sequence is not null").select(bases.alias("sequence"))
    total = rows.count()
    summary = rows.mapInArrow(_frequent(math.ceil(2 / share)), "sequence string, least long")
    able = summary.groupBy("sequence").agg(F.sum("least").alias("least")).filter(F.col("least") >= share * total / 2 - 1)
    able = F.broadcast(able.select(F.col("sequence").alias("_s")))
    counted = rows.join(able, F.col("sequence") == F.col("_s"), "left_semi").groupBy("sequence").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= share * total).withColumn("share", F.col("n") / max(1, total))


def adapter_content(reads: DataFrame, adapters: dict[str, str]) -> DataFrame:
    """(adapter, position, n, share): the reads in which an adapter begins at a position or before it, by position up to
    the last at which it begins; in any letter case."""
    first = [F.struct(F.lit(name).alias("adapter"), F.instr(F.upper("sequence"), seq.upper()).alias("at")) for name, seq in adapters.items()]
    total = reads.filter("sequence is not null").count()
    begun = reads.select(F.explode(F.array(*first)).alias("f")).filter("f.at > 0").groupBy("f.adapter", (F.col("f.at") - 1).alias("position")).agg(F.count("*").alias("own"))
    so_far = Window.partitionBy("adapter").orderBy("position")  # a row a position
    n = F.sum("own").over(so_far)
    return begun.select("adapter", "position", n.alias("n"), (n / max(1, total)).alias("share"))


def tables(reads: DataFrame, adapters: dict[str, str], share: float = 0.001) -> dict[str, DataFrame]:
    """Every table of a report, by name; reads as with_stats() makes them for the quality histogram."""
    from readloom.operators.reads import with_stats

    return {
        "positions": per_position(reads), "lengths": length_histogram(reads), "gc": gc_histogram(reads),
        "qualities": quality_histogram(with_stats(reads)), "duplication": duplication_levels(reads),
        "bases": base_content(reads), "overrepresented": overrepresented(reads, share), "adapters": adapter_content(reads, adapters),
    }
