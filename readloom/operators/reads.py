"""Operators on reads: DataFrame in, DataFrame out; reads have id, sequence, quality, and read_idx where order counts."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from readloom.functions.sequences import (
    distance_score,
    first_start,
    last_end,
    phred,
    rank_quantile,
    reverse_complement_text,
)
from readloom.operators.kmers import distinct_kmers, kmer_counts  # noqa: F401  part of this module's interface
from readloom.sources.staging import materialize

LOW_QUALITY = 15


def _share(letter: str) -> Column:
    return (F.col("length") - F.length(F.replace("sequence", F.lit(letter), F.lit("")))) / F.col("length")


def with_stats(reads: DataFrame) -> DataFrame:
    """Add the derived columns of a read: ends, length, composition, quality mean, deviation, rank quantiles, score.

    Empty sequences and qualities shorter than the sequence are dropped (see rejects()). G takes every letter that is
    not A, T or C; N is the share of bases under Q15. Computed in double, kept as float.
    """
    own = ["prefix", "suffix", "length", "A", "T", "C", "G", "N", "GC", "AT", "Q_Score", "std_QScore", "q25", "q50", "q75", "q90", "ScoreDist"]
    df = reads.drop(*own).filter((F.length("sequence") > 0) & (F.length("quality") >= F.length("sequence")))
    df = df.withColumns({"length": F.length("sequence"), "_q": phred(F.substring(F.col("quality"), F.lit(1), F.length("sequence")))})
    total = F.aggregate("_q", F.lit(0).cast("long"), lambda s, x: s + x)
    squares = F.aggregate("_q", F.lit(0).cast("long"), lambda s, x: s + x * x)
    df = df.withColumns({"_o": F.array_sort("_q"), "_sum": total, "_sq": squares, "A": _share("A"), "T": _share("T"), "C": _share("C")})
    mean = F.col("_sum") / F.col("length")
    low = F.size(F.filter("_q", lambda x: x < LOW_QUALITY)) / F.col("length")
    df = df.withColumns({
        "prefix": F.substring("sequence", 1, 50), "suffix": F.expr("right(sequence, 50)"),
        "G": 1 - F.col("A") - F.col("T") - F.col("C"), "N": low, "Q_Score": mean,
        "std_QScore": F.sqrt(F.greatest(F.lit(0.0), F.col("_sq") / F.col("length") - mean * mean)),
        **{f"q{p}": rank_quantile("_o", p / 100).cast("double") for p in (25, 50, 75, 90)},
    })
    df = df.withColumns({"GC": F.col("C") + F.col("G"), "ScoreDist": distance_score(*map(F.col, ("Q_Score", "q25", "q50", "q75", "q90")))})
    df = df.withColumn("AT", 1 - F.col("GC"))
    floats = [c for c in own if c not in ("prefix", "suffix", "length")]
    return df.select(*reads.drop(*own).columns, *[F.col(c).cast("float").alias(c) if c in floats else F.col(c) for c in own])


def rejects(reads: DataFrame) -> DataFrame:
    """Reads that with_stats() drops."""
    return reads.filter(~F.coalesce((F.length("sequence") > 0) & (F.length("quality") >= F.length("sequence")), F.lit(False)))


class StageCounts:
    """Rows that pass each stage of a plan, counted while a job runs it; no job of their own."""

    def __init__(self) -> None:
        self._stages: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        """df, counted as `stage`. The plan must run once, whole: write it, and go on from what is written."""
        self._stages[stage] = Observation()
        return df.observe(self._stages[stage], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> list[tuple[str, int, int]]:
        """(stage, rows kept, rows dropped since the stage before), in order; waits until the plan has run."""
        kept = [(stage, o.get["rows"]) for stage, o in self._stages.items()]
        return [(stage, n, kept[k - 1][1] - n if k else 0) for k, (stage, n) in enumerate(kept)]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "stage string, kept long, dropped long")


def quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact quantiles, name -> (column, share), by linear interpolation between ranks; null where a column has no value.

    Rows are reduced to counts by value, which combine before their shuffle; a range partitioning of the values then
    gives running totals, so that no task holds a whole column. Two rows a quantile reach the driver.
    """
    columns = sorted({c for c, _ in wanted.values()})
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")
    values = df.select(each).select("x.*").filter("v is not null").groupBy("c", "v").agg(F.count("*").alias("n"))
    values = materialize(values.repartitionByRange("c", "v").withColumn("p", F.spark_partition_id()), "values")
    sums = values.groupBy("c", "p").agg(F.sum("n").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("c", "p", before.alias("before"), F.sum("t").over(Window.partitionBy("c")).alias("total"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("c", "p").orderBy("v"))
    ranked = values.join(F.broadcast(sums), ["c", "p"]).withColumn("upto", upto)
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(c).alias("of"), F.lit(float(q)).alias("q")) for name, (c, q) in wanted.items()]))
    found = ranked.select("*", asked.alias("a")).filter("a.of = c").withColumn("place", F.expr("a.q * (total - 1)"))
    found = found.filter("upto > floor(place) and upto - n <= ceil(place)").select("a.name", "v", "place", "upto", "n").collect()
    out: dict[str, float | None] = dict.fromkeys(wanted)
    for name in wanted:
        rows = sorted((r for r in found if r["name"] == name), key=lambda r: r["v"])
        if rows:
            place, low = rows[0]["place"], math.floor(rows[0]["place"])
            at = lambda k, rows=rows: next(r["v"] for r in rows if r["upto"] > k)
            high = math.ceil(place)
            out[name] = at(low) if low == high else (high - place) * at(low) + (place - low) * at(high)
    return out


def _with_limits(reads: DataFrame, wanted: dict[str, tuple[str, float]], keep: Callable[[dict], Column]) -> DataFrame:
    """Filter by thresholds that may be quantiles, rounded to float as thresholds are."""
    found = quantiles(reads, wanted) if wanted else {}
    return reads.filter(keep({k: F.lit(v).cast("float") for k, v in found.items()}))


def _size_rule(inf: float, sup: float) -> tuple[dict, Callable[[dict], Column]]:
    wanted = ({"inf": ("length", inf)} if 0 <= inf < 1 else {}) | ({"sup": ("length", sup)} if 0 < sup <= 1 else {})
    fixed = {"inf": F.lit(float(inf)).cast("float"), "sup": F.lit(float(sup)).cast("float")}
    size = F.col("length").cast("float")
    return wanted, lambda found: size.between((fixed | found)["inf"], (fixed | found)["sup"])


def filter_size(reads: DataFrame, inf: float = 0.0, sup: float = 1.0) -> DataFrame:
    """inf <= length <= sup; inf in [0, 1) and sup in (0, 1] are quantiles of length, other values absolute."""
    return _with_limits(reads, *_size_rule(inf, sup))


def filter_q(reads: DataFrame, threshold: float = 20.0) -> DataFrame:
    return reads.filter(F.col("Q_Score") >= F.lit(threshold).cast("float"))


def filter_quality(reads: DataFrame, threshold: float = 1.0) -> DataFrame:
    """ScoreDist up to its quantile."""
    return _with_limits(reads, {"d": ("ScoreDist", threshold)}, lambda found: F.col("ScoreDist") <= found["d"])


def filter_n(reads: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Share of low-quality bases up to its quantile."""
    return _with_limits(reads, {"n": ("N", threshold)}, lambda found: F.col("N") <= found["n"])


def filter_gc(reads: DataFrame, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return reads.filter(F.col("GC").between(F.lit(low).cast("float"), F.lit(high).cast("float")))


def filter_duplicates(reads: DataFrame, order: tuple[str, ...] = ("read_idx",)) -> DataFrame:
    """The first read, in order, of each 50-character prefix.

    The smallest order value is found by an aggregation that combines before its shuffle, so a prefix of a third of the
    reads meets as one row a task; reads then stay by a semi join that adaptive execution can split.
    """
    prefix = F.substring("sequence", 1, 50)
    firsts = reads.groupBy(prefix.alias("_p")).agg(F.min(F.struct(*order)).alias("_first"))
    return reads.join(firsts, (prefix == F.col("_p")) & (F.struct(*order) == F.col("_first")), "left_semi")


def cut_primers(reads: DataFrame, forwards: list[str], reverses: list[str], min_length: int = 1, both_strands: bool = False) -> DataFrame:
    """Keep reads with a forward primer before a reverse-complemented reverse one, cut to the span, primers included.

    With both_strands, reads that fail as they are may pass as their reverse complement.
    """
    from readloom.functions.sequences import reverse_complement

    ends = [reverse_complement_text(r) for r in reverses]

    def cut(df: DataFrame) -> DataFrame:
        df = df.withColumns({"_b": first_start("sequence", forwards), "_e": last_end("sequence", ends)}).filter("coalesce(_b < _e, false)")
        span = [F.substring(F.col(c), F.col("_b") + 1, F.col("_e") - F.col("_b")) for c in ("sequence", "quality")]
        return df.withColumns(dict(zip(("sequence", "quality"), span, strict=True))).filter(F.length("sequence") >= min_length).drop("_b", "_e")

    if both_strands:
        found = (first_start("sequence", forwards) < last_end("sequence", ends)) & True
        turned = ~F.coalesce(found, F.lit(False))
        reads = reads.withColumn("_t", turned).withColumns({
            "sequence": F.when(F.col("_t"), reverse_complement("sequence")).otherwise(F.col("sequence")),
            "quality": F.when(F.col("_t"), F.reverse("quality")).otherwise(F.col("quality")),
        }).drop("_t")
    out = cut(reads)
    return with_stats(out) if "Q_Score" in reads.columns else out


def _cropped(size: Column, value: float, strict_parity: bool) -> Column:
    """How many bases a head or tail value takes from a read."""
    v = F.lit(value).cast("float").cast("double")
    amount = (size * v).cast("float").cast("double") if 0 < value < 1 else v
    if strict_parity and 0 < value < 1:
        amount = F.when(amount < 1, (size * amount).cast("float").cast("double")).otherwise(amount)
    return F.bround(amount).cast("int")


def crop(reads: DataFrame, head: float = 0.0, tail: float = 0.0, strict_parity: bool = False) -> DataFrame:
    """Cut bases from the head, then the tail: a fraction of the original length below 1, else a number; 0: none.

    strict_parity scales a fraction again where it yields under one base, and counts a tail longer than the read from
    its end. Emptied reads go; statistics are computed anew where they were present.
    """
    size = F.length("sequence")
    df = reads
    if head > 0:
        df = df.withColumn("_h", _cropped(size, head, strict_parity))
    if tail > 0:
        df = df.withColumn("_t", _cropped(size, tail, strict_parity))
    if head > 0:
        rest = F.greatest(F.lit(0), F.length("sequence") - F.col("_h"))
        df = df.withColumns({c: F.substring(F.col(c), F.col("_h") + 1, rest) for c in ("quality", "sequence")}).drop("_h")
    if tail > 0:
        n = F.length("sequence")
        past = F.greatest(F.lit(0), 2 * n - F.col("_t")) if strict_parity else F.lit(0)
        keep = F.when(F.col("_t") <= n, n - F.col("_t")).otherwise(past)
        df = df.withColumns({c: F.substring(F.col(c), F.lit(1), keep) for c in ("quality", "sequence")}).drop("_t")
    df = df.filter(F.length("sequence") > 0)
    return with_stats(df) if "Q_Score" in reads.columns else df


def multi_filter(
    reads: DataFrame, size_inf: float = 0.0, size_sup: float = 1.0, quality: float = 1.0, n: float = 1.0,
    head: float = 0.0, tail: float = 0.0, min_gc: float = 0.0, max_gc: float = 1.0, duplicated: bool = False,
    strict_parity: bool = False,
) -> DataFrame:
    """Size, quality, N and GC filters with all thresholds from the input, in one pass; then crop; then duplicates.

    The statistics are written once, as thresholds and filter both read them.
    """
    reads = materialize(reads, "reads")
    wanted, size = _size_rule(size_inf, size_sup)
    wanted |= {"d": ("ScoreDist", quality), "n": ("N", n)}
    gc = F.col("GC").between(F.lit(min_gc).cast("float"), F.lit(max_gc).cast("float"))
    out = _with_limits(reads, wanted, lambda found: size(found) & (F.col("ScoreDist") <= found["d"]) & (F.col("N") <= found["n"]) & gc)
    out = crop(out, head, tail, strict_parity) if head > 0 or tail > 0 else out
    return filter_duplicates(out) if duplicated else out


def by_ids(reads: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Reads whose id is in ids; repeated ids all stay."""
    return reads.join(ids.select(F.col(id_col).alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_semi")


def _draw(seed: int, *key: str) -> Column:
    """A seeded hash of the key that any SQL engine can compute."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def sample(reads: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n reads without replacement, by the order of a seeded hash."""
    return reads.withColumn("_r", _draw(seed, "id")).orderBy("_r", "id").limit(n).drop("_r")


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(_draw(seed, key), key)


def stratified(df: DataFrame, label: str, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """The first rows of each label in hash order, fraction of its rows rounded half to even.

    Counts by label and leading hash digits tell the stretch in which a label's last row lies; only that stretch, one in
    65,536 of the label, is sorted.
    """
    held = df.withColumns({"_d": _draw(seed, key)}).withColumn("_b", F.substring("_d", 1, 4))
    sizes = held.groupBy(F.col(label).alias("_y"), "_b").agg(F.count("*").alias("_n"))
    by = Window.partitionBy("_y")
    whole = F.bround(F.sum("_n").over(by) * F.lit(fraction)).cast("long").alias("_want")
    sizes = sizes.select("_y", "_b", "_n", F.sum("_n").over(by.orderBy("_b")).alias("_upto"), whole)
    edge = sizes.filter("_upto >= _want and _upto - _n < _want").select("_y", F.col("_b").alias("_edge"), F.expr("_want - (_upto - _n)").alias("_rest"))
    held = held.join(F.broadcast(edge), F.col(label).eqNullSafe(F.col("_y")))
    order = Window.partitionBy("_y").orderBy("_d", key)
    last = held.filter("_b = _edge").withColumn("_k", F.row_number().over(order)).filter("_k <= _rest")
    return held.filter("_b < _edge").select(*df.columns).union(last.select(*df.columns))


def fastq_lines(reads: DataFrame) -> DataFrame:
    return reads.select(F.concat_ws("\n", "id", "sequence", F.lit("+"), "quality").alias("value"))


def fasta_lines(reads: DataFrame) -> DataFrame:
    return reads.select(F.concat(F.lit(">"), F.expr("substr(id, 2)"), F.lit("\n"), F.col("sequence")).alias("value"))
