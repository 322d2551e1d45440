"""Counts of k-mers: two bits a base in a long, counted and shuffled as sorted runs of codes, in ranges that are in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.sequences import kmers

LETTERS = np.frombuffer(b"ACGT", np.uint8)
_CODE = np.full(256, 4, np.uint8)
_CODE[LETTERS] = np.arange(4)
#: Bases that a long holds, at most.
LONGEST = 31
#: Letters whose counts give the ranges' bounds.
HEAD = 7
#: Codes of a range, about; of a run that a task sorts before it sends it, and merges with others, at most about.
RANGE_CODES, RUN_CODES = 8_000_000, 8_000_000
#: Codes of a range at least.
LEAST_CODES = 500_000
#: Rows of results that leave a task at once.
OUT_ROWS = 200_000


def packed(data: np.ndarray, size: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the k-mers of A, C, G and T, begins of the others) in sequences of the given sizes, one after another."""
    n, end = len(data), np.cumsum(size)
    codes = np.r_[_CODE[data], np.zeros(k, np.uint8)]
    value, odd = np.zeros(n, np.int64), np.zeros(n, bool)
    for j in range(k):
        c = codes[j : n + j]
        odd |= c > 3
        value = value << 2 | c & 3
    whole = np.arange(n) <= np.repeat(end - k, size)
    return value[whole & ~odd], np.flatnonzero(whole & odd)


def unpacked(codes: np.ndarray, k: int) -> pa.Array:
    """The k-mers of codes, as strings."""
    text = np.empty((len(codes), k), np.uint8)
    for j in range(k):
        text[:, j] = LETTERS[(codes >> (2 * (k - 1 - j))) & 3]
    return pa.Array.from_buffers(pa.string(), len(codes), [None, pa.py_buffer(np.arange(0, k * len(codes) + 1, k, dtype=np.int32)), pa.py_buffer(text)])


def _texts(b: pa.RecordBatch) -> tuple[str, np.ndarray, np.ndarray]:
    """The sequences of a batch in one text, the same with a byte a character, and their sizes."""
    texts = [t for t in b.column(0).to_pylist() if t]
    every = "".join(texts)
    return every, np.frombuffer(every.encode("latin-1", "replace"), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))


def _heads(k: int):
    """Rows (head, n, others): how many k-mers begin with the letters that head stands for, and how many have other
    characters than A, C, G and T."""
    head = min(k, HEAD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, others = np.zeros(4**head, np.int64), 0
        for b in batches:
            _, data, size = _texts(b)
            end, n = np.cumsum(size), len(data)
            codes = np.r_[_CODE[data], np.zeros(k, np.uint8)]
            gone = np.r_[0, np.cumsum(codes > 3, dtype=np.int64)]
            value = np.zeros(n, np.int32)
            for j in range(head):
                value = value << 2 | codes[j : n + j] & 3
            whole, plain = np.arange(n) <= np.repeat(end - k, size), gone[k : n + k] == gone[:n]
            total += np.bincount(value[whole & plain], minlength=4**head)
            others += int((whole & ~plain).sum())
        at = np.flatnonzero(total)
        cols = [np.r_[at, 0], np.r_[total[at], 0], np.r_[np.zeros(len(at), np.int64), others]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["head", "n", "others"])

    return run


def _bounds(heads: np.ndarray, n: np.ndarray, k: int, cores: int) -> np.ndarray:
    """The least code of every range but the first, so that a range has about RANGE_CODES codes, fewer if cores would else
    be idle, or a single head."""
    room = np.cumsum(n) // min(RANGE_CODES, max(LEAST_CODES, int(n.sum()) // (2 * cores)))
    return heads[1:][room[1:] > room[:-1]] << 2 * (k - min(k, HEAD))


def _shrunk(run: np.ndarray) -> tuple[int, int, bytes]:
    """A sorted run as (first, bytes a step, steps), steps byte by byte so that equal ones lie together."""
    steps = np.diff(run)
    wide = 8 if len(steps) and int(steps.max()) >= 1 << 32 else 4
    return int(run[0]), wide, np.ascontiguousarray(steps.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T).tobytes()


def _grown(first: int, wide: int, steps: bytes) -> np.ndarray:
    planes = np.frombuffer(steps, np.uint8).reshape(wide, -1)
    out = np.empty(planes.shape[1] + 1, np.int64)
    out[0], out[1:] = first, np.ascontiguousarray(planes.T).view(f"<u{wide}").ravel()
    return np.cumsum(out)


def _summed(codes: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, in order, and their counts; n: what each stands for (None: one)."""
    if n is None:
        codes = np.sort(codes)
        begin = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
        return codes[begin], np.diff(np.r_[begin, len(codes)])
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    begin = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    return codes[begin], np.add.reduceat(n, begin) if len(begin) else n


def _runs(k: int, bounds: np.ndarray):
    """Rows (part, first, wide, steps, n): sorted runs of codes by range, n null where each counts once."""
    names = ["part", "first", "wide", "steps", "n"]

    def out(held: list[np.ndarray]) -> pa.RecordBatch:
        codes, n = _summed(np.concatenate(held), None)
        ends = np.r_[0, np.searchsorted(codes, bounds), len(codes)]
        rows = []
        for part in np.flatnonzero(np.diff(ends)).tolist():
            here = slice(ends[part], ends[part + 1])
            times = n[here].astype("<i8").tobytes() if (n[here] > 1).any() else None
            rows.append((part, *_shrunk(codes[here]), times))
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            codes = packed(*_texts(b)[1:], k)[0]
            held.append(codes)
            size += len(codes)
            if size >= RUN_CODES:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)

    return run


def _merged(k: int, counted: bool):
    """Rows (kmer, n), or kmer alone, of the runs of each range, in order where the ranges are."""
    names = ["kmer", "n"] if counted else ["kmer"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, base = None, [], 0, 0

        def settled() -> list[tuple[np.ndarray, np.ndarray | None]]:
            codes = np.concatenate([c for c, _ in held])
            once = all(n is None for _, n in held)
            return [_summed(codes, None if once else np.concatenate([np.ones(len(c), np.int64) if n is None else n for c, n in held]))]

        def out() -> Iterator[pa.RecordBatch]:
            codes, n = settled()[0]
            for at in range(0, len(codes), OUT_ROWS):
                cols = [unpacked(codes[at : at + OUT_ROWS], k), pa.array(n[at : at + OUT_ROWS])]
                yield pa.RecordBatch.from_arrays(cols[: len(names)], names=names)

        for b in batches:
            for p, first, wide, steps, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != part and held:
                    yield from out()
                    held, size, base = [], 0, 0
                part = p
                held.append((_grown(first, wide, steps), None if n is None else np.frombuffer(n, "<i8")))
                size += len(held[-1][0])
                if size >= 2 * max(RUN_CODES, base) and len(held) > 1:
                    # What repeats is added up at once, so that a range takes room for its distinct codes.
                    held = settled()
                    size = base = len(held[0][0])
        if held:
            yield from out()

    return run


def _counted(reads: DataFrame, k: int, counted: bool) -> tuple[DataFrame, DataFrame | None]:
    """The k-mers of A, C, G and T, by ranges in order, and those with other characters (None if there are none)."""
    texts = reads.select("sequence")
    heads = texts.mapInArrow(_heads(k), "head long, n long, others long").groupBy("head")
    heads = heads.agg(F.sum("n").alias("n"), F.sum("others").alias("others")).orderBy("head").toArrow()
    bounds = _bounds(heads["head"].to_numpy(), heads["n"].to_numpy(), k, reads.sparkSession.sparkContext.defaultParallelism)
    runs = texts.mapInArrow(_runs(k, bounds), "part int, first long, wide int, steps binary, n binary")
    runs = runs.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part")
    plain = runs.mapInArrow(_merged(k, counted), "kmer string, n long" if counted else "kmer string")
    if not sum(heads["others"].to_pylist()):
        return plain, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every, data, size = _texts(b)
            yield pa.RecordBatch.from_arrays([pa.array([every[i : i + k] for i in packed(data, size, k)[1].tolist()], pa.string())], names=["kmer"])

    odd = texts.mapInArrow(run, "kmer string").groupBy("kmer").agg(F.count("*").alias("n"))
    return plain, odd if counted else odd.select("kmer")


def kmer_counts(reads: DataFrame, k: int = 21) -> DataFrame:
    """(kmer, n): how often each substring of k characters occurs in the column `sequence`; letter case counts.

    One pass counts first letters, for ranges of about RANGE_CODES codes; runs of codes are shuffled by range, a few bytes
    a code, and merged there. k-mers with other characters than A, C, G and T are counted as strings. Null sequences have
    none.
    """
    if not 1 <= k <= LONGEST:
        each = reads.select(F.explode(kmers("sequence", k)).alias("kmer"))
        return each.groupBy("kmer").agg(F.count("*").alias("n"))
    plain, odd = _counted(reads, k, True)
    return plain if odd is None else plain.union(odd)


def distinct_kmers(reads: DataFrame, k: int = 21) -> DataFrame:
    """The column kmer, in order: that of the ranges, unless other characters than A, C, G and T occur."""
    if not 1 <= k <= LONGEST:
        return kmer_counts(reads, k).select("kmer").orderBy("kmer")
    plain, odd = _counted(reads, k, False)
    return plain if odd is None else plain.union(odd).orderBy("kmer")
