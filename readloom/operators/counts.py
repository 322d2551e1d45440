"""Counts by barcode and species, thresholds on class probabilities, and evaluation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.sequences import log10_count
from readloom.operators.nearest import nearest


def complete_counts(hits: DataFrame, barcodes: DataFrame, species: DataFrame) -> DataFrame:
    """(barcode, species, n, log10_n, seen) with a row for every pair, counts of zero included.

    barcodes and species are dimensions: their product is the result's size and does not grow with the reads.
    """
    n = hits.groupBy("barcode", "species").agg(F.count("*").alias("n"))
    pairs = barcodes.select("barcode").distinct().crossJoin(F.broadcast(species.select("species").distinct()))
    out = pairs.join(n, ["barcode", "species"], "left").select("barcode", "species", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return out.withColumn("log10_n", log10_count("n")).withColumn("seen", F.col("log10_n") >= 1)


def matrix(counts: DataFrame, species: list[str], value: str = "log10_n", label: str = "{}") -> DataFrame:
    """Wide table: a row for each barcode, a column for each species named by `label`."""
    wide = counts.groupBy("barcode").pivot("species", species).agg(F.first(value)).na.fill(0.0)
    return wide.select("barcode", *[F.col(f"`{s}`").alias(label.format(s)) for s in species])


def mapped(alignments: DataFrame, min_mapq: int = 40) -> DataFrame:
    """Alignment records that are mapped with at least a mapping quality."""
    return alignments.filter((F.col("flag").bitwiseAND(4) == 0) & (F.col("mapq") >= min_mapq))


def confident(scored: DataFrame, threshold: float = 0.9, probs: str = "probs", prediction: str = "prediction") -> DataFrame:
    """Rows whose predicted class has at least this probability."""
    return scored.filter(F.get(probs, F.col(prediction).cast("int")) >= threshold)


def threshold_counts(scored: DataFrame, thresholds: dict[str, float], labels: list[str], probs: str = "probs", by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., species, threshold, n_reads_detected): each class judged by its own threshold, so a read may count for
    several. Without `by` there is one group, even of no rows."""
    sums = [F.coalesce(F.count_if(F.get(probs, F.lit(labels.index(s))) >= t), F.lit(0)).alias(f"_{k}") for k, (s, t) in enumerate(thresholds.items())]
    wide = scored.groupBy(*by).agg(*sums)
    rows = F.array(*[F.struct(F.lit(s).alias("species"), F.lit(t).cast("decimal(3,2)").alias("threshold"), F.col(f"_{k}").alias("n_reads_detected")) for k, (s, t) in enumerate(thresholds.items())])
    return wide.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def mean_probability(scored: DataFrame, labels: list[str], probs: str = "probs", by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., species, mean_probability), highest first."""
    each = scored.select(*by, F.posexplode_outer(probs).alias("k", "p")).filter("k is not null").groupBy(*by, "k").agg(F.avg("p").alias("mean_probability"))
    named = each.select(*by, F.get(F.array(*map(F.lit, labels)), F.col("k")).alias("species"), "mean_probability")
    return named.orderBy(*by, F.desc("mean_probability"), "species")


def unique_labels(df: DataFrame, label: str) -> list[str]:
    """The labels that occur, in order; nulls are none."""
    return [r[0] for r in df.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("y")).distinct().orderBy("y").collect()]


def confusion(df: DataFrame, label: str, prediction: str, classes: list) -> DataFrame:
    """Rows are true classes, columns predicted ones."""
    return df.groupBy(label).pivot(prediction, classes).count().na.fill(0)


def micro_recall(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("recall"))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """precision, recall, f1 and support of each class, with rows for accuracy, macro and weighted averages; 0 for 0/0."""
    cells = df.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select(F.col("y").alias("class"), "n", F.lit(0).alias("said"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("right"))
    sides = sides.union(cells.select("p", F.lit(0), "n", F.lit(0)))
    each = sides.groupBy("class").agg(F.sum("n").alias("support"), F.sum("said").alias("said"), F.sum("right").alias("right"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    each = each.select("class", "support", "right", ratio(F.col("right"), F.col("said")).alias("precision"), ratio(F.col("right"), F.col("support")).alias("recall"))
    each = each.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    scores = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")
    accuracy = F.sum("right") / F.sum("support")
    rows = each.select("class", *scores, "support")
    rows = rows.union(each.agg(F.lit("accuracy").alias("class"), *[accuracy.alias(s) for s in scores], total).select("class", *scores, "support"))
    rows = rows.union(each.agg(F.lit("macro avg").alias("class"), *[F.avg(s).alias(s) for s in scores], total))
    return rows.union(each.agg(F.lit("weighted avg").alias("class"), *[(F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(s) for s in scores], total))


#: Values (rows times dimensions) of a block of queries in knn_vote, about.
QUERY_VALUES = 200_000


def knn_vote(queries: DataFrame, points: DataFrame, features: str, label: str, key: str, k: int = 5) -> DataFrame:
    """(key, prediction): the commonest label of the k nearest points, ties to the smallest label.

    Equal distances go by key, unknown ones come last. Every query meets every point, as blocks in tasks of bounded size:
    the time is that of all pairs, a matrix product's, and the rows that are shuffled are k a query and task.
    """
    x = F.col(features).cast("array<double>").alias("x")
    asked = queries.select(F.col(key).alias("tag"), x)
    held = points.select(F.col(label).alias("tag"), x, F.col(key).alias("at"))
    near = nearest(asked, held, k, QUERY_VALUES)
    best = near.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("level", "d", "rank"))).filter(F.col("r") <= k)
    votes = best.groupBy("query", "y").agg(F.count("*").alias("n"))
    first = F.min_by("y", F.struct(-F.col("n"), F.col("y").isNull(), F.col("y"))).alias("prediction")
    return votes.groupBy("query").agg(first).withColumnRenamed("query", key)
