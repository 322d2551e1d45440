"""Exact dedup over a persistent digest index (operator 13), in DataFrame and SQL operations alone.

The index is a folder of Parquet files, bucketed by digest and sorted by it within each file: one row for each digest
seen so far, with the row that brought it. A batch of new rows is reduced to one row a digest (combined before its
shuffle), which is dealt out as the buckets are; a sort-merge anti-join with the index, which is neither shuffled nor
collected, leaves the digests that are new, and they are appended. A batch that is added again after a failure appends
what is missing and no more.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import materialize, parts, shared_dir, table

COLUMNS = "digest BINARY, doc_id BIGINT, row BIGINT, batch STRING"


class DigestIndex:
    """The index in the folder `path`, made there unless it exists. `buckets` counts for a new one alone."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        try:
            self.buckets = spark.read.parquet(f"{self.path}/about").first().buckets
        except AnalysisException:
            self.buckets = buckets or parts(spark)
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.parquet(f"{self.path}/about")
        # The catalog of a session may be its own: the table is named again over the files that lie there.
        self.name = "digests_" + hashlib.md5(self.path.encode()).hexdigest()
        place = f"{self.path}/digests".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({COLUMNS}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'")

    def rows(self) -> DataFrame:
        """digest, doc_id and row of what stays, and the batch that brought it; one row a digest."""
        return self.spark.table(self.name)

    def add(self, rows: DataFrame, batch: str) -> DataFrame:
        """Add rows (digest, doc_id, row) under the name of a batch; returns those that stay: of each digest that no
        other batch has brought the row with the largest doc_id, then the largest row. A null id is below all others."""
        best = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("_best"))
        best = best.select("digest", "_best.doc_id", "_best.row")
        fresh = best.join(self.rows().filter(F.col("batch") != batch).hint("merge"), "digest", "left_anti")
        begun = self.rows().filter(F.col("batch") == batch)
        missing = fresh if begun.isEmpty() else fresh.join(begun.hint("merge"), "digest", "left_anti")
        missing.select("digest", "doc_id", "row", F.lit(batch).alias("batch")).write.insertInto(self.name)
        return fresh

    def compact(self, path: str) -> DigestIndex:
        """The same rows in a new folder, one sorted file a bucket, for after many batches."""
        new = DigestIndex(self.spark, path, self.buckets)
        self.rows().repartition(self.buckets, "digest").write.insertInto(new.name)
        return new


def text_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(digest, doc_id, row) of each row of docs; null texts count as empty. Written once, so that row stays the same."""
    hashed = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    rows = docs.select(hashed.alias("digest"), F.col(doc_id).cast("long").alias("doc_id"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def _dealt_anew(digest: Column) -> Column:
    """A digest under another name, by which neither side of a join lies dealt out: adaptive execution then splits the
    rows of a digest that very many share."""
    return F.concat(F.lit(bytearray(b"\1")), digest)


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", batches: int = 2, path: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id (id of the row that stays of those with its text), group_size,
    kept and text_sha256. Texts are equal when their bytes are; null counts as empty.

    Of equal texts the row with the largest doc_id stays, of rows that repeat an id too one of them; null ids are below
    all others. The rows pass through a new digest index in `path` (a folder of its own by default) in batches by ranges
    of ids, the largest ids first, so that what a batch finds in the index has a larger id. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = text_digests(docs, text, doc_id)
    index = DigestIndex(spark, path or f"{shared_dir(spark)}/index-{uuid.uuid4().hex}")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = -(-(high - low + 1) // batches) if low is not None else 1
    place = F.coalesce(F.floor((F.lit(high) - F.col("doc_id")) / width), F.lit(batches - 1)) if low is not None else F.lit(0)
    for k in range(batches):
        index.add(rows.filter(place == k), f"{k}")
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    stays = index.rows().select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("_row")).join(sizes, "digest")
    stays = stays.withColumnRenamed("digest", "_digest")
    done = rows.join(stays.hint("merge"), _dealt_anew(F.col("digest")) == _dealt_anew(F.col("_digest")))
    return done.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


#: DuckDB SQL for op13_exact_dedup.
OP13_SQL = """
with d as (select doc_id, coalesce(text, '') as t, row_number() over () as r from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  row_number() over (partition by t order by doc_id desc nulls last, r) = 1 as kept, sha256(t) as text_sha256
from d window g as (partition by t)
"""
