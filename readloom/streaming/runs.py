"""An extension: amplicon counts by barcode over a run folder that still grows, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.config import PRIMERS, RANGES
from readloom.operators.reads import cut_primers

READ_SCHEMA = "read_idx long, id string, barcode string, sequence string, quality string"


def stream_amplicons(spark: SparkSession, folder: str, primers: str = "CHERIF", files_per_batch: int = 100) -> DataFrame:
    """Trimmed reads of Parquet files of reads, as they arrive; stateless."""
    p, (low, high) = PRIMERS[primers], RANGES[primers]
    reads = spark.readStream.schema(READ_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return cut_primers(reads, p["forwards"], p["reverses"], low).filter(F.length("sequence") <= high)


def running_counts(stream: DataFrame) -> DataFrame:
    """Counts by barcode; the state is one row a barcode."""
    return stream.groupBy("barcode").agg(F.count("*").alias("n_reads"))
