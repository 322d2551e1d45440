"""Readers and writers of sequencing files, as DataFrames; lines are read by Spark, so any store it knows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.functions.sequences import barcode_of
from readloom.operators.reads import fasta_lines, fastq_lines


def read_fastq(spark: SparkSession, path: str, stop_at_empty: bool = True) -> DataFrame:
    """FASTQ files (plain or .gz, globs allowed): file, barcode, read_idx, id (with @), sequence, quality.

    One file is one row while it is split, as four-line records need the order of lines: use read_large_fastq for files
    of more than some hundred MB. stop_at_empty ends a file at its first empty sequence line; otherwise such
    records stay. An incomplete last record is dropped.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = F.transform(F.split("value", "\n"), lambda x: F.rtrim(F.regexp_replace(x, r"\s+$", "")))
    df = whole.select("file", lines.alias("l"))
    starts = F.expr("if(size(l) >= 4, sequence(0, size(l) - 4, 4), cast(array() as array<int>))")
    df = df.withColumn("s", starts)
    if stop_at_empty:
        stop = "array_position(transform(s, i -> l[i + 1] = ''), true)"
        df = df.withColumn("s", F.expr(f"if({stop} > 0, slice(s, 1, int({stop}) - 1), s)"))
    records = F.expr("transform(s, i -> named_struct('id', l[i], 'sequence', l[i + 1], 'quality', l[i + 3]))")
    df = df.select("file", F.posexplode_outer(records).alias("at", "r")).filter("at is not null")
    return df.select("file", barcode_of("file").alias("barcode"), F.col("at").cast("long").alias("read_idx"), "r.*")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a path or glob as a table: file, barcode, bytes, modified. Their contents are not read; files without
    a byte are left out."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(F.col("path").alias("file"), barcode_of("path").alias("barcode"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the folders that a glob meets, in any store that Spark knows; empty ones too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted({f.getPath().getName() for f in found or () if f.isDirectory()})


def read_large_fastq(spark: SparkSession, path: str, stop_at_empty: bool = True) -> DataFrame:
    """The rows of read_fastq, with every file read in splits by many tasks (a .gz file is one split).

    A line's number is its place in its split plus the lines of the file's earlier splits, whose counts are a small table;
    the lines of a record then meet by an aggregation. Nothing holds a whole file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"\s+$", "").alias("value"),
    )
    splits = lines.groupBy("file", "split").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "split", (earlier - F.col("first")).alias("shift"))
    lines = lines.join(F.broadcast(splits), ["file", "split"]).withColumn("line", F.col("at") + F.col("shift"))
    part = {n: F.max(F.when(F.col("line") % 4 == k, F.col("value"))).alias(n) for k, n in ((0, "id"), (1, "sequence"), (3, "quality"))}
    records = lines.groupBy("file", F.floor(F.col("line") / 4).alias("read_idx")).agg(*part.values(), F.count("*").alias("n")).filter("n = 4")
    if stop_at_empty:
        ends = records.filter("sequence = ''").groupBy("file").agg(F.min("read_idx").alias("stop"))
        records = records.join(F.broadcast(ends), "file", "left").filter("stop is null or read_idx < stop")
    return records.select("file", barcode_of("file").alias("barcode"), "read_idx", "id", "sequence", "quality")


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Sequences alone, without an early stop."""
    return read_fastq(spark, path, stop_at_empty=False).select("sequence")


def read_fasta(spark: SparkSession, path: str, stop_at_blank: bool = False) -> DataFrame:
    """FASTA files: file, ordinal, header (without >), sequence with wrapped lines joined; \\r is ignored.

    stop_at_blank ends a file at its first blank line; otherwise blank lines are skipped.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r", "").alias("v"))
    if stop_at_blank:
        whole = whole.withColumn("v", F.regexp_extract("v", r"(?s)^(.*?)(?:\n[ \t]*\n|\z)", 1))
    parts = F.posexplode_outer(F.filter(F.split("v", r"(?:^|\n)>"), lambda x: F.trim(x) != "")).alias("ordinal", "p")
    df = whole.select("file", parts).filter("ordinal is not null")
    header, body = F.trim(F.regexp_extract("p", r"^[^\n]*", 0)), F.regexp_replace(F.regexp_replace("p", r"^[^\n]*\n?", ""), r"\s", "")
    return df.select("file", "ordinal", header.alias("header"), body.alias("sequence"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment lines of SAM text: qname, flag, rname, pos, mapq, cigar, seq; header lines are skipped."""
    f = F.split("value", "\t")
    names = (("qname", 0, "string"), ("flag", 1, "int"), ("rname", 2, "string"), ("pos", 3, "int"), ("mapq", 4, "int"), ("cigar", 5, "string"), ("seq", 9, "string"))
    lines = spark.read.text(path).filter(~F.col("value").startswith("@") & (F.size(f) > 9))
    return lines.select(*[F.get(f, F.lit(k)).cast(kind).alias(name) for name, k, kind in names])


def read_clustal(spark: SparkSession, path: str) -> DataFrame:
    """CLUSTAL alignments: file, name, aligned (blocks joined in order)."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = whole.select("file", F.posexplode_outer(F.split("value", r"\r?\n")).alias("k", "line"))
    pattern = r"^(\S+)\s+([A-Za-z*.-]+)(?:\s+[0-9]+)?\s*$"
    rows = lines.filter(F.col("line").rlike(pattern) & ~F.col("line").startswith("CLUSTAL"))
    rows = rows.select("file", "k", F.regexp_extract("line", pattern, 1).alias("name"), F.regexp_extract("line", pattern, 2).alias("block"))
    blocks = F.array_sort(F.collect_list(F.struct("k", "block")))
    return rows.groupBy("file", "name").agg(F.array_join(F.transform(blocks, lambda b: b["block"]), "").alias("aligned"))


def read_table(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """Metadata tables with a header; short rows get nulls."""
    return spark.read.csv(path, header=True, schema=schema, sep=sep, mode="PERMISSIVE", ignoreTrailingWhiteSpace=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Comma-separated tables with a header, of the given schema: nothing is read to guess types."""
    return spark.read.csv(path, header=True, schema=schema)


def interval(text: str) -> tuple[F.Column, F.Column]:
    """Start and end of a text like (577, 693)."""
    return tuple(F.regexp_extract(text, rf"\(\s*(-?[0-9]+)\s*,\s*(-?[0-9]+)\s*\)", k).try_cast("int") for k in (1, 2))


def write_reads(reads: DataFrame, path: str, form: str = "fq", compression: str | None = None) -> None:
    """Write FASTQ (fq) or FASTA (fa) text; an unknown form raises before anything is written."""
    if form not in ("fq", "fa"):
        raise ValueError(f"form: fq or fa, not {form}")
    lines = fastq_lines(reads) if form == "fq" else fasta_lines(reads)
    lines.write.text(path, compression=compression)


def write_encoded(df: DataFrame, path: str, n: int, label: str | None = None) -> None:
    """CSV of encoded sequences (column features): integer headers, the label last."""
    cols = [F.col("features")[i].alias(str(i)) for i in range(n)]
    df.select(*cols, *([F.col(label).alias(str(n))] if label else [])).write.csv(path, header=True)
