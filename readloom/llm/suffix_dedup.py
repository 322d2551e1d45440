"""Exact removal of repeated byte strings by difference-cover suffix buckets (operator 10).

Texts are dealt as packed chunks. A difference cover of the residues modulo PERIOD marks one position in nine; any two
equal strings of `length` bytes have a marked position at the same place within their first PERIOD bytes, so both hold
an equal sample of SAMPLE = length - PERIOD + 1 bytes there. The steps, each over one bucket of suffixes at a time:

1. names: every sample's hash goes to the bucket of its leading bits; names that occur once are dropped, and the
   repeated ones return to their chunk.
2. ties: around each repeated sample lie PERIOD strings of `length` bytes that it can prove. Samples whose whole
   surroundings (PERIOD - 1 bytes before, `length` after) occur again have all of them proved. This settles the
   inside of long repeats by names alone, without their bytes; the surroundings' hash is of another family.
3. suffixes: samples at the edge of a repeat go to the bucket with their surroundings' bytes (one copy of each).
   A bucket's cover-sample suffixes are sorted by their bytes, which gives each its rank, and what precedes them is
   sorted likewise. A suffix that starts some bytes before a sample is then compared by those bytes and, where they
   tie, by the sample's rank alone; neighbours in that order with `length` equal bytes are proved.
4. hot names: a name with more than HOT_SAMPLES samples at edges is not put into one bucket. Each of its samples sends
   a hash of every string of `length` bytes that it can prove to the bucket of that hash, where those that occur again
   are found as in step 1, so that the name spreads over all tasks.

A chunk then removes the bytes under its proved strings. Memory per task is a chunk or one bucket; nothing is
collected. Two strings that are not proved by their bytes were equal in two independent 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.chunks import batch_of, by_bucket, pack, rows_of, unpack
from readloom.llm.common import materialize, ship, table

#: A difference cover of the residues modulo 91; every difference occurs, by ten marked residues.
PERIOD = 91
COVER = (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 6 << 20
#: Samples at edges that one name may put into one bucket.
HOT_SAMPLES = 4096
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    size = 1 << max(21, int(n - 1).bit_length())
    if size not in _TABLES:
        _TABLES.clear()
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            both.append(p)
        _TABLES[size] = both[0], both[1]
    return _TABLES[size]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class _Rolling:
    """Hashes of any substrings of a byte buffer, in constant time each."""

    def __init__(self, data: np.ndarray) -> None:
        self.up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[: len(data)], out=self.sums[1:])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


class _Chunk:
    """A packed chunk: the bytes of its texts, where each begins, and the marked positions of long enough texts."""

    def __init__(self, chunk_id: int, sizes: list[int], packed: bytes, length: int) -> None:
        self.size = np.array(sizes, np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.raw = unpack(sizes, packed)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.rolling = _Rolling(self.data)
        out = []
        sample = length - PERIOD + 1
        for k in np.flatnonzero(self.size >= length).tolist():
            # Each text starts at a residue of its own, so that aligned copies share one position in a period, not ten.
            shift = xxhash.xxh32_intdigest(f"{chunk_id}/{k}") % PERIOD
            periods = np.arange(0, self.size[k] + PERIOD, PERIOD)[:, None]
            marks = (periods + (np.array(COVER) - shift) % PERIOD).ravel()
            marks.sort()
            out.append(marks[marks <= self.size[k] - sample] + self.begin[k])
        self.marks = np.concatenate(out) if out else np.empty(0, np.int64)
        owner = np.searchsorted(self.begin, self.marks, side="right") - 1
        self.low = self.begin[owner]
        self.high = self.low + self.size[owner]
        self.names = self.rolling.at(self.marks, self.marks + sample)

    def around(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the surroundings of marks, cut at the text's ends."""
        return np.maximum(self.low[at], self.marks[at] - PERIOD + 1), np.minimum(self.high[at], self.marks[at] + length)


def _chunks(batch: pa.RecordBatch, length: int) -> Iterator[tuple[dict, _Chunk]]:
    for x in rows_of(batch):
        yield x, _Chunk(x["chunk_id"], x["sizes"], x["packed"], length)


def _halves(names: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    """40 bits of names that follow the bucket's."""
    rest = (names << np.uint64(bits)) >> np.uint64(24)
    return rest.astype("<u4").tobytes(), (rest >> np.uint64(32)).astype(np.uint8).tobytes()


def _sample_names(bits: int, length: int):
    """Chunk -> rows (bucket, chunk_id, 40 further bits of each name as 4 + 1 bytes)."""
    schema = pa.schema([("bucket", pa.int64()), ("chunk_id", pa.int64()), ("low", pa.binary()), ("high", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, c in _chunks(batch, length):
                rows = []
                for bucket, at in by_bucket(c.names, bits):
                    rows.append((bucket, x["chunk_id"], *_halves(c.names[at], bits)))
                if rows:
                    yield batch_of(rows, schema)

    return run, "bucket long, chunk_id long, low binary, high binary"


def _repeated_names(t: pa.Table) -> pa.Table:
    """One bucket -> per chunk the places (within its sorted names of this bucket) of names that occur again."""
    low = [np.frombuffer(x.as_py(), "<u4").astype(np.uint64) for x in t["low"]]
    high = [np.frombuffer(x.as_py(), np.uint8).astype(np.uint64) for x in t["high"]]
    each = [a | (b << np.uint64(32)) for a, b in zip(low, high, strict=True)]
    every = np.sort(np.concatenate(each))
    again = every[1:][every[1:] == every[:-1]]
    again = again[np.r_[True, again[1:] != again[:-1]]] if len(again) else again
    chunk, hits = [], []
    for i, x in zip(t["chunk_id"].to_pylist(), each, strict=True):
        if len(again):
            at = np.minimum(np.searchsorted(again, x), len(again) - 1)
            at = np.flatnonzero(again[at] == x)
            if len(at):
                chunk.append(i)
                hits.append(at.astype("<u4").tobytes())
    bucket = t["bucket"][0].as_py()
    return pa.table({"chunk_id": pa.array(chunk, pa.int64()), "bucket": pa.array([bucket] * len(chunk), pa.int64()), "hits": pa.array(hits, pa.binary())})


def _hit_marks(c: _Chunk, found: list[dict] | None, bits: int) -> np.ndarray:
    """Marks of the chunk whose names are repeated."""
    places = {f["bucket"]: np.frombuffer(f["hits"], "<u4") for f in found or []}
    out = [at[places[bucket]] for bucket, at in by_bucket(c.names, bits) if bucket in places]
    return np.sort(np.concatenate(out)) if out else np.empty(0, np.int64)


def _ties(bits: int, length: int):
    """Chunk with its repeated names -> rows (bucket, chunk_id, names, hashes of the surroundings), marks in order of name."""
    schema = pa.schema([("bucket", pa.int64()), ("chunk_id", pa.int64()), ("names", pa.binary()), ("wholes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, c in _chunks(batch, length):
                hit = _hit_marks(c, x["found"], bits)
                start, end = c.around(hit, length)
                whole = np.fromiter((xxhash.xxh3_64_intdigest(c.raw[s:e]) for s, e in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(hit))
                # Cut surroundings differ from whole ones, and from those cut elsewhere.
                whole = _mix(whole + ((c.marks[hit] - start) * 1024 + (end - start)).astype(np.uint64))
                rows = [(b, x["chunk_id"], c.names[hit[at]].tobytes(), whole[at].tobytes()) for b, at in by_bucket(c.names[hit], bits)]
                if rows:
                    yield batch_of(rows, schema)

    return run, "bucket long, chunk_id long, names binary, wholes binary"


SETTLED, OPEN, HOT = 1, 2, 4


def _settle(hot_samples: int):
    """One bucket -> per chunk a byte for each repeated name: bit SETTLED if the surroundings recur, OPEN to send them
    on, HOT to send on their strings' hashes; and the number of hot ones."""

    def run(t: pa.Table) -> pa.Table:
        return _settle_bucket(t, hot_samples)

    return run


def _settle_bucket(t: pa.Table, hot_samples: int) -> pa.Table:
    names = [np.frombuffer(x.as_py(), np.uint64) for x in t["names"]]
    wholes = [np.frombuffer(x.as_py(), np.uint64) for x in t["wholes"]]
    sizes = [len(x) for x in names]
    name, whole = np.concatenate(names), np.concatenate(wholes)
    order = np.lexsort((whole, name))
    n, w = name[order], whole[order]
    new_name = np.r_[True, n[1:] != n[:-1]]
    new_whole = new_name | np.r_[True, w[1:] != w[:-1]]
    run = np.cumsum(new_whole) - 1
    recurs = (np.bincount(run) > 1)[run]
    klass = np.cumsum(new_name) - 1
    unsure = np.bincount(klass, ~recurs) > 0
    lone = np.bincount(klass) < 2
    send = unsure[klass] & ~lone[klass] & (~recurs | new_whole)
    state = np.zeros(len(n), np.uint8)
    hot = (np.bincount(klass, send) > hot_samples)[klass] & send
    state[order] = recurs * SETTLED + (send & ~hot) * OPEN + hot * HOT
    ends = np.cumsum(sizes)
    states = [state[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
    bucket = pa.array([t["bucket"][0].as_py()] * len(sizes), pa.int64())
    count = pa.array([np.count_nonzero(np.frombuffer(x, np.uint8) & HOT) for x in states], pa.int64())
    return pa.table({"chunk_id": t["chunk_id"], "bucket": bucket, "states": pa.array(states, pa.binary()), "hot": count})


def _states(c: _Chunk, x: dict, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(marks with a repeated name, their states)."""
    hit = _hit_marks(c, x["found"], bits)
    state = np.zeros(len(hit), np.uint8)
    by = {s["bucket"]: np.frombuffer(s["states"], np.uint8) for s in x["settled"] or []}
    for b, at in by_bucket(c.names[hit], bits):
        if b in by:
            state[at] = by[b]
    return hit, state


def _edges(bits: int, length: int):
    """Chunk -> rows (bucket, chunk_id, names, and the surroundings of marks in state OPEN, packed)."""
    schema = pa.schema([("bucket", pa.int64()), ("chunk_id", pa.int64()), ("names", pa.binary()), ("before", pa.binary()), ("size", pa.binary()), ("texts", pa.binary())])
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        for batch in batches:
            for x, c in _chunks(batch, length):
                hit, state = _states(c, x, bits)
                hit = hit[(state & OPEN) > 0]
                start, end = c.around(hit, length)
                rows = []
                for b, at in by_bucket(c.names[hit], bits):
                    texts = b"".join(c.raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True))
                    before, size = (c.marks[hit[at]] - start[at]).astype(np.uint8), (end[at] - start[at]).astype("<u2")
                    rows.append((b, x["chunk_id"], c.names[hit[at]].tobytes(), before.tobytes(), size.tobytes(), press.compress(texts)))
                if rows:
                    yield batch_of(rows, schema)

    return run, "bucket long, chunk_id long, names binary, before binary, size binary, texts binary"


def _rows(data: np.ndarray, start: np.ndarray, size: np.ndarray, step: int, width: int) -> np.ndarray:
    """Bytes from each start on, forwards or backwards (step 1 or -1), as rows of a matrix with zeros past each size."""
    out = np.zeros((len(start), width), np.uint8)
    for k in range(width):
        at = np.flatnonzero(size > k)
        out[at, k] = data[start[at] + step * k]
    return out


def _ranked(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their bytes, a row before those that it begins, and how many bytes each has in common with the
    one before it in that order."""
    # Zeros end a row or belong to it: the size tells, as an odd number, so that no row ends in a zero byte.
    sized = np.concatenate([rows, (2 * size + 1).astype(">u4").view(np.uint8).reshape(-1, 4)], axis=1)
    order = np.argsort(sized.view(f"S{sized.shape[1]}").ravel(), kind="stable")
    differ = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, np.r_[0, np.minimum(common, np.minimum(size[order[1:]], size[order[:-1]]))][: len(order)]


def _sort_suffixes(length: int):
    """One bucket of surroundings -> per chunk and mark a bit for each offset whose `length` bytes occur again."""

    def run(t: pa.Table) -> pa.Table:
        unpress = zstandard.ZstdDecompressor()
        sizes = [len(x.as_py()) // 8 for x in t["names"]]
        before = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in t["before"]]).astype(np.int64)
        size = np.concatenate([np.frombuffer(x.as_py(), "<u2") for x in t["size"]]).astype(np.int64)
        data = np.frombuffer(b"".join(unpress.decompress(x.as_py()) for x in t["texts"]), np.uint8)
        mark = np.cumsum(size) - size + before
        after = size - before
        by_rank, common = _ranked(_rows(data, mark, after, 1, length), after)
        by_past, shared = _ranked(_rows(data, mark - 1, before, -1, PERIOD - 1), before)
        proved, rank, past = np.zeros((len(mark), PERIOD), bool), np.empty(len(mark), np.int64), np.empty(len(mark), np.int64)
        for back in range(PERIOD):
            # Marks agree in both halves of the string if nothing between them in either order differs earlier.
            rank[by_rank] = np.cumsum(common < length - back)
            past[by_past] = np.cumsum(shared < back)
            at = np.flatnonzero((before >= back) & (after >= length - back))
            _, place, n = np.unique(rank[at] * (len(mark) + 1) + past[at], return_inverse=True, return_counts=True)
            proved[at[n[place] > 1], back] = True
        bits, ends = np.packbits(proved, axis=1), np.cumsum(sizes)
        rows = [bits[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
        bucket = pa.array([t["bucket"][0].as_py()] * len(rows), pa.int64())
        return pa.table({"chunk_id": t["chunk_id"], "bucket": bucket, "proved": pa.array(rows, pa.binary())})

    return run


def _strings(c: _Chunk, hot: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, name) of every string of `length` bytes that hot marks can prove, once each."""
    start, end = c.around(hot, length)
    at = np.concatenate([np.arange(s, e - length + 1) for s, e in zip(start.tolist(), end.tolist(), strict=True)] or [np.empty(0, np.int64)])
    at = np.unique(at)
    return at, c.rolling.at(at, at + length)


def _hot_strings(bits: int, length: int):
    """Chunk -> rows (bucket, chunk_id, low, high) of the strings at its hot marks, like _sample_names."""
    schema = pa.schema([("bucket", pa.int64()), ("chunk_id", pa.int64()), ("low", pa.binary()), ("high", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, c in _chunks(batch, length):
                hit, state = _states(c, x, bits)
                _, names = _strings(c, hit[(state & HOT) > 0], length)
                rows = [(b, x["chunk_id"], *_halves(names[at], bits)) for b, at in by_bucket(names, bits)]
                if rows:
                    yield batch_of(rows, schema)

    return run, "bucket long, chunk_id long, low binary, high binary"


def _cut(bits: int, length: int, keep_text: bool):
    """Chunk with all results -> one row for each text: what is removed and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, c in _chunks(batch, length):
                hit, state = _states(c, x, bits)
                change = np.zeros(len(c.data) + 1, np.int32)
                start, end = c.around(hit[(state & SETTLED) > 0], length)
                # Whole surroundings of at least `length` bytes recur: every string in them does.
                full = end - start >= length
                np.add.at(change, start[full], 1)
                np.add.at(change, end[full], -1)
                opened = hit[(state & OPEN) > 0]
                by = {p["bucket"]: np.frombuffer(p["proved"], np.uint8).reshape(-1, (PERIOD + 7) // 8) for p in x["proved"] or []}
                for b, at in by_bucket(c.names[opened], bits):
                    if b in by:
                        row, back = np.nonzero(np.unpackbits(by[b], axis=1, count=PERIOD))
                        begin = c.marks[opened[at[row]]] - back
                        np.add.at(change, begin, 1)
                        np.add.at(change, begin + length, -1)
                start, names = _strings(c, hit[(state & HOT) > 0], length)
                by = {h["bucket"]: np.frombuffer(h["hits"], "<u4") for h in x["hot"] or []}
                for b, at in by_bucket(names, bits):
                    if b in by:
                        begin = start[at[by[b]]]
                        np.add.at(change, begin, 1)
                        np.add.at(change, begin + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                out = []
                for i, a, n in zip(x["ids"], c.begin.tolist(), c.size.tolist(), strict=True):
                    g = gone[a : a + n]
                    spans = np.flatnonzero(np.diff(np.r_[False, g, False].astype(np.int8)))
                    left = c.data[a : a + n][~g].tobytes() if len(spans) else c.raw[a : a + n]
                    more = [spans.tolist(), left] if keep_text else []
                    out.append((i, n, int(g.sum()), len(spans) // 2, hashlib.sha256(left).hexdigest(), *more))
                cols = list(zip(*out))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, types)], names=names[: len(cols)])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return run, schema + (", spans array<long>, kept binary" if keep_text else "")


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = 200,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot_samples: int = HOT_SAMPLES,
    keep_text: bool = True,
) -> DataFrame:
    """Remove every byte under a string of `length` bytes that also starts anywhere else, in the same text or another.

    One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with keep_text, `spans`
    (start and end of each removed run, in turn) and `kept` (the bytes left). Null texts count as empty, null ids and
    repeated rows stay (copies remove each other), other columns are ignored, texts never join. length >= 2 * PERIOD.
    """
    if length < 2 * PERIOD or length > 900:
        raise ValueError(f"length: {2 * PERIOD} to 900 bytes")
    spark = docs.sparkSession
    ship(spark)
    chunks = pack(docs, text, doc_id, chunk_bytes, "chunks")
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    bits = max(0, int(total * 5 * len(COVER) // PERIOD // bucket_bytes).bit_length())

    def gathered(df: DataFrame, *cols: str) -> DataFrame:
        """The results of a step by chunk."""
        packed = F.collect_list(F.struct("bucket", cols[0])).alias(cols[1])
        return df.groupBy("chunk_id").agg(packed).hint("shuffle_hash")

    run, schema = _sample_names(bits, length)
    names = chunks.mapInArrow(run, schema).groupBy("bucket")
    found = gathered(names.applyInArrow(_repeated_names, "chunk_id long, bucket long, hits binary"), "hits", "found")
    chunks = materialize(chunks.join(found, "chunk_id", "left"), "found")
    run, schema = _ties(bits, length)
    ties = chunks.mapInArrow(run, schema).groupBy("bucket")
    settled = ties.applyInArrow(_settle(hot_samples), "chunk_id long, bucket long, states binary, hot long")
    settled = materialize(settled, "settled")
    chunks = chunks.join(gathered(settled, "states", "settled"), "chunk_id", "left")
    marked = settled.filter("hot > 0").select(F.col("chunk_id").alias("_c")).distinct()
    if marked.isEmpty():
        hot = None
    else:
        run, schema = _hot_strings(bits, length)
        hot = chunks.join(marked, F.col("chunk_id") == F.col("_c"), "left_semi").mapInArrow(run, schema).groupBy("bucket")
        hot = gathered(hot.applyInArrow(_repeated_names, "chunk_id long, bucket long, hits binary"), "hits", "hot")
    run, schema = _edges(bits, length)
    edges = chunks.mapInArrow(run, schema).groupBy("bucket")
    proved = gathered(edges.applyInArrow(_sort_suffixes(length), "chunk_id long, bucket long, proved binary"), "proved", "proved")
    run, schema = _cut(bits, length, keep_text)
    done = chunks.join(proved, "chunk_id", "left")
    done = done.join(hot, "chunk_id", "left") if hot else done.withColumn("hot", F.lit(None).cast("array<struct<bucket: bigint, hits: binary>>"))
    return done.mapInArrow(run, schema)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
