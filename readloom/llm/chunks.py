"""Texts packed into chunk rows: work by the megabyte, and results of any step return to their texts by chunk_id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import materialize

CHUNK_SCHEMA = "chunk_id long, ids array<long>, sizes array<long>, packed binary"


def pack(docs: DataFrame, text: str, doc_id: str, chunk_bytes: int, tag: str) -> DataFrame:
    """Rows (chunk_id, ids, sizes, packed) of up to chunk_bytes of UTF-8 text each, or one longer text; null is empty.

    The rows are written once, so chunk_id stays the same however often a later step is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, texts, size, serial = [], [], 0, TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(3)

        def flush() -> pa.RecordBatch:
            nonlocal ids, texts, size, serial
            longs = pa.list_(pa.int64())
            packed = press.compress(b"".join(texts))
            cols = [pa.array([serial]), pa.array([ids], longs), pa.array([[len(t) for t in texts]], longs), pa.array([packed])]
            ids, texts, size, serial = [], [], 0, serial + 1
            return pa.RecordBatch.from_arrays(cols, names=["chunk_id", "ids", "sizes", "packed"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                value = t.as_py() or b""
                if texts and size + len(value) > chunk_bytes:
                    yield flush()
                ids.append(i)
                texts.append(value)
                size += len(value)
        if texts:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_b"))
    return materialize(rows.mapInArrow(run, CHUNK_SCHEMA), tag)


def unpack(sizes: list[int], packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed, max_output_size=sum(sizes) + 1)


def texts_of(sizes: list[int], packed: bytes) -> Iterator[bytes]:
    data, at = unpack(sizes, packed), 0
    for n in sizes:
        yield data[at : at + n]
        at += n


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for row in range(batch.num_rows):
        yield {name: batch.column(name)[row].as_py() for name in batch.schema.names}


def by_bucket(names: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket of the leading bits, positions of its names in order of the name)."""
    order = np.argsort(names)
    bucket = (names[order] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    ends = np.r_[cuts[1:], len(bucket)] if len(bucket) else []
    for a, b in zip(cuts, ends, strict=True):
        yield int(bucket[a]), order[a:b]


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
