"""Synthetic amplicons: random ones, and species templates with sequencing errors."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.config import AMPLICONS, LABELS, PRIMERS, RANGES
from readloom.functions.sequences import encode, reverse_complement_text

LETTERS = "ATCG"


def _primers(raw_reverse: bool) -> tuple[str, str]:
    """Forward primer and the other end: the reverse primer's complement as in trimmed reads, or the primer itself."""
    p = PRIMERS["CHERIF"]
    return p["forwards"][0], p["reverses"][0] if raw_reverse else reverse_complement_text(p["reverses"][0])


def random_amplicons(spark: SparkSession, n: int, seed: int = 42, raw_reverse: bool = False) -> DataFrame:
    """n distinct amplicons in order, labelled unidentified; total length uniform from 150 up to but not 160."""
    forward, other = _primers(raw_reverse)
    low, high = RANGES["CHERIF"]
    inner = F.lit(low) + F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(high - low)).cast("int") - len(forward) - len(other)
    letter = lambda i: F.substring(F.lit(LETTERS), F.pmod(F.xxhash64("id", i, F.lit(seed + 1)), F.lit(4)).cast("int") + 1, F.lit(1))
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.col("inner")), letter), "")
    made = spark.range(n + n // 50 + 10).withColumn("inner", inner).select(F.concat(F.lit(forward), body, F.lit(other)).alias("sequence"))
    return made.dropDuplicates().orderBy("sequence").limit(n).withColumn("species", F.lit("unidentified"))


def with_errors(sequence: str, rng: random.Random, low: float, high: float, room: int) -> str:
    """A copy with errors at a rate drawn from whole per cents in [low, high): half substitutions, the rest indels.

    Indels apply from left to right at their original places; an insertion happens only while the copy stays under room.
    """
    rate = rng.randrange(round(low * 100), max(round(low * 100) + 1, round(high * 100))) / 100
    letters, indels = list(sequence), []
    for at in sorted(rng.sample(range(len(sequence)), round(len(sequence) * rate))):
        kind = rng.random()
        if kind < 0.5:
            letters[at] = rng.choice([c for c in LETTERS if c != letters[at]])
        else:
            indels.append((at, "" if kind < 0.75 else rng.choice(LETTERS)))
    text = "".join(letters)
    for at, insert in indels:
        if not insert:
            text = text[:at] + text[at + 1 :]
        elif len(text) + 1 < room:
            text = text[:at] + insert + text[at:]
    return text


def errored_amplicons(templates: DataFrame, n: int, low: float = 0.0, high: float = 0.15, seed: int = 42, raw_reverse: bool = False) -> DataFrame:
    """n amplicons with errors for each row of templates (species, sequence between the primers): species, copy, sequence.

    Every copy has a generator of its own, seeded by species and number, so a repeated task makes the same rows.
    """
    forward, other = _primers(raw_reverse)
    room = RANGES["CHERIF"][1] - len(forward) - len(other)
    copies = templates.select("species", "sequence", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, q, c in zip(*(col.to_pylist() for col in b.columns), strict=True):
                rng = random.Random(f"{seed}/{s}/{c}")
                out.append((s, c, forward + with_errors(q, rng, low, high, room) + other))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.string()), strict=True)], names=["species", "copy", "sequence"])

    return copies.mapInArrow(run, "species string, copy int, sequence string")


def templates(fasta: DataFrame) -> DataFrame:
    """Species templates from FASTA rows (file, sequence): the smallest sequence of each file, cut to its amplicon."""
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), "[.].*$", "")
    least = fasta.groupBy(name.alias("species")).agg(F.min("sequence").alias("sequence"))
    places = fasta.sparkSession.createDataFrame([(s, a, b) for s, (a, b) in zip(LABELS, AMPLICONS, strict=False)], "species string, a int, b int")
    return least.join(F.broadcast(places), "species").select("species", F.substring(F.col("sequence"), F.col("a") + 1, F.col("b") - F.col("a")).alias("sequence"))


def dataset(rows: DataFrame) -> DataFrame:
    """(features array<int> of the longest amplicon's length, species) of labelled sequences."""
    return rows.select(encode("sequence", RANGES["CHERIF"][1]).alias("features"), "species")
