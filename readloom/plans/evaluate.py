"""What a model says of unlabelled reads, for all barcodes in one job, as tables and CSV folders."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators import counts, models
from readloom.sources.staging import materialize


def analyse(model: PipelineModel, rows: DataFrame, thresholds: dict[str, float], idx: str = "read_idx") -> dict[str, DataFrame]:
    """Five tables by barcode of rows (barcode, idx, features):

    predictions (idx, prediction), probabilities (idx, a column for each class), distribution (prediction, n),
    average_class (species, mean_probability), and detected (species, threshold, n_reads_detected), in which each class
    is judged by its own threshold. The model is evaluated once.
    """
    labels = models.labels_of(model)
    scored = models.predict(model, rows.select("barcode", F.col(idx).alias("idx"), "features"))
    scored = materialize(scored.select("barcode", "idx", "predicted", "probs"), "scored")
    every = [F.get("probs", F.lit(k)).alias(name) for k, name in enumerate(labels)]
    return {
        "predictions": scored.select("barcode", "idx", F.col("predicted").alias("prediction")),
        "probabilities": scored.select("barcode", "idx", *every),
        "distribution": scored.groupBy("barcode", F.col("predicted").alias("prediction")).agg(F.count("*").alias("n")),
        "average_class": counts.mean_probability(scored, labels, by=("barcode",)),
        "detected": counts.threshold_counts(scored, thresholds, labels, by=("barcode",)),
    }


def write_analysis(tables: dict[str, DataFrame], out: str) -> None:
    """Each table as CSV under out/<table>/barcode=<barcode>/."""
    for name, table in tables.items():
        table.write.partitionBy("barcode").csv(f"{out}/{name}", header=True, mode="overwrite")
