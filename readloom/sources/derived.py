"""Reads derived from the events table, written once a session so that operators start from a plain scan."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from readloom.sources.staging import shared_dir

FORWARD, REVERSE_RC = "GCGGTAATTCCAGCTCCA", "CGTGTGCGCTTAATTGAGTG"
_WRITTEN: dict[tuple[str, str], str] = {}
#: Reads of a task and of a file: at most, and at least where there are cores to spare.
MOST_READS, LEAST_READS = 100_000, 5_000


def reads_sql(text: str) -> str:
    """SELECT of the reads of `events`, in Spark's (text = STRING) or DuckDB's (VARCHAR) spelling.

    One read an event: 128 or more letters made from a digest, with primers in three of four. One event in ten repeats
    the contents of an earlier one, so that distinct contents and copies both grow with the table.
    """
    e = f"cast(k as {text})"
    letters = " || ".join(f"translate(md5('{x}' || {e}), '0123456789abcdef', 'ACGTACGTACGTACGT')" for x in "abcd")
    scores = f"translate(md5('q' || {e}), '0123456789abcdef', '+,-./0123456789:')"
    cut = lambda n: f"substr(body, 1, cast({n} as int))"
    return f"""
      select event_id as read_idx, '@r' || cast(event_id as {text}) as id,
             'barcode' || lpad(cast(event_id % 12 + 1 as {text}), 2, '0') as barcode, sequence,
             substr(repeat(scores, 8), 1, length(sequence)) as quality
      from (
        select event_id, scores, case when k % 4 <> 0
          then {cut('k % 7')} || '{FORWARD}' || {cut('110 + k % 16')} || '{REVERSE_RC}' || {cut('k % 5')} else body end as sequence
        from (
          select event_id, k, {letters} as body, {scores} as scores
          from (select event_id, case when event_id % 10 = 0 and event_id >= 100 then cast(floor(event_id / 100) as bigint) else event_id end as k from events) c
        ) a
      ) b"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_idx, id, barcode, sequence, quality for every event with an id.

    Ids are dealt evenly before reads are made of them: a row of events compresses to a few bytes, so one split of their
    file would else be one task, and one row group of reads that all later scans take in one task too.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = f"{shared_dir(spark)}/reads-{uuid.uuid4().hex}"
        view = f"events_{uuid.uuid4().hex}"
        events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_id is not null").select("event_id")
        n = events.count()
        parts = max(1, -(-n // MOST_READS), min(2 * spark.sparkContext.defaultParallelism, n // LEAST_READS))
        events.repartition(parts, "event_id").createOrReplaceTempView(view)
        spark.sql(reads_sql("STRING").replace("from events)", f"from {view})")).write.parquet(path)
        spark.catalog.dropTempView(view)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])
