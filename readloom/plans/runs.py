"""Whole runs over a folder of barcodes: trimmed reads, species counts by alignment or by a classifier, result tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.config import LABELS, RANGES, primer_set
from readloom.functions.sequences import encode, species_name
from readloom.operators import counts, models
from readloom.operators.align import align
from readloom.operators.calibration import Calibration
from readloom.operators.reads import StageCounts, cut_primers, filter_size
from readloom.sources.files import list_folders, read_fasta, read_fastq
from readloom.sources.staging import materialize


def trimmed(reads: DataFrame, primers: str = "CHERIF", counters: StageCounts | None = None) -> DataFrame:
    """Reads cut to their primers and within the primer set's length range, for all barcodes in one plan.

    counters watch the reads as they come, after the cut and after the length filter.
    """
    p = primer_set(primers)
    watch = counters.watch if counters else lambda df, stage: df
    cut = watch(cut_primers(watch(reads, "reads"), list(p.forwards), list(p.reverses), p.shortest), "cut to primers")
    kept = filter_size(cut.withColumn("length", F.length("sequence")), float(p.shortest), float(p.longest)).drop("length")
    return watch(kept, "within length range")


def barcodes_of(spark: SparkSession, run_folder: str) -> DataFrame:
    """The barcodes of a run by its folders alone: one whose files hold no read is there too."""
    return spark.createDataFrame([(name,) for name in list_folders(spark, f"{run_folder}/barcode*")], "barcode string")


def load_run(spark: SparkSession, run_folder: str) -> DataFrame:
    return read_fastq(spark, f"{run_folder}/barcode*/*.fastq.gz")


def vectors(reads: DataFrame) -> DataFrame:
    """barcode and features of trimmed CHERIF reads, as the classifier takes them."""
    return reads.filter("sequence is not null").select("barcode", encode("sequence", RANGES["CHERIF"][1]).alias("features"))


def labelled_reads(reads: DataFrame, references: DataFrame, species: str, mapq: int = 60, k: int = 28) -> DataFrame:
    """A real test set: features of trimmed reads that map in one species with at least a mapping quality, and its label.

    references: ref_id and sequence of that species. Each read counts once, whichever reference it meets.
    """
    kept = trimmed(reads)
    hits = counts.mapped(align(kept, references.withColumn("species", F.lit(species)), k), mapq).select(F.col("id").alias("_id")).distinct()
    found = kept.join(hits, F.col("id") == F.col("_id"), "left_semi")
    return vectors(found).select("features", F.lit(species.replace(" ", "_")).alias("species"))


def mapping_counts(reads: DataFrame, references: DataFrame, barcodes: DataFrame, k: int = 28, mapq: int = 40) -> DataFrame:
    """(barcode, species, n, log10_n, seen) of reads mapped in each species with at least a mapping quality."""
    hits = counts.mapped(align(reads, references, k), mapq)
    return counts.complete_counts(hits, barcodes, references)


def classified_counts(reads: DataFrame, model: PipelineModel, barcodes: DataFrame, threshold: float = 0.9, calibration: Calibration | None = None) -> DataFrame:
    """(barcode, species, n, log10_n, seen) of reads whose predicted class has at least a probability.

    Trimmed reads and predictions are written in between: the optimizer would else merge trimming, model and threshold
    into one filter, which evaluates the model several times a row, and on reads that trimming drops. With a
    calibration, the threshold is one of calibrated probabilities.
    """
    rows = materialize(vectors(reads), "vectors")
    scored = materialize(models.predict(model, rows, calibration).select("barcode", "prediction", "predicted", "probs"), "scored")
    hits = counts.confident(scored, threshold).withColumnRenamed("predicted", "species")
    names = reads.sparkSession.createDataFrame([(x,) for x in LABELS], "species string")
    return counts.complete_counts(hits, barcodes, names)


def run(
    spark: SparkSession, run_folder: str, out: str, species_folder: str | None = None, model: PipelineModel | None = None,
    primers: str = "CHERIF", k: int = 28, mapq: int = 40, threshold: float = 0.9, counters: StageCounts | None = None,
    calibration: Calibration | None = None,
) -> DataFrame:
    """Map against the FASTA files of species_folder, or classify with a model; write the wide log10 table as CSV.

    Every barcode of the folder has a row, one without a read too. The files are read once: trimmed reads are written in
    between, which also fills `counters`.
    """
    if (species_folder is None) == (model is None):
        raise ValueError("give either species_folder or model")
    if model is not None and primers.upper() != "CHERIF":
        raise ValueError("the classifier knows CHERIF amplicons only")
    barcodes = barcodes_of(spark, run_folder)
    reads = materialize(trimmed(load_run(spark, run_folder), primers, counters), "trimmed")
    if model is not None:
        long, names, label = classified_counts(reads, model, barcodes, threshold, calibration), list(LABELS), f"{{}} ({threshold} <= p)"
    else:
        fasta = read_fasta(spark, f"{species_folder}/*.fasta")
        refs = fasta.select(species_name("file").alias("species"), F.concat_ws("/", "file", "ordinal").alias("ref_id"), "sequence")
        names = sorted(r[0] for r in refs.select("species").distinct().collect())
        long, label = mapping_counts(reads, refs, barcodes, k, mapq), f"{{}} ({mapq} <= MapQ)"
    wide = counts.matrix(long, names, label=label)
    wide.coalesce(1).write.csv(out, header=True, mode="overwrite")
    return spark.read.schema(wide.schema).csv(out, header=True)
