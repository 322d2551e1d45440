"""A Spark data source for FASTQ files: spark.read.format("fastq").load(path), after register(spark).

Plain files are read in byte ranges by as many tasks; a task starts at the first record that begins in its range and
finishes the one that begins last, so no line is shuffled and no file is read twice. A .gz file is one range. Columns:
file, barcode, offset (of the record's first byte in the unpacked file; orders the records of a file), id (with @),
sequence, quality. Option splitBytes sets the size of a range. Files are opened by pyarrow, in the stores that it knows.
"""

from __future__ import annotations

import fnmatch
import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 64 << 20
#: Records of an Arrow batch, and bytes that are read at once.
RECORDS, PIECE = 4096, 1 << 20
SCHEMA = "file string, barcode string, offset long, id string, sequence string, quality string"


def _listed(path: str) -> tuple[pyarrow.fs.FileSystem, list[pyarrow.fs.FileInfo]]:
    """Files of a path, a folder or a glob, by name; hidden ones and those of a job in progress are left out."""
    system, place = pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file://{path}")
    if re.search(r"[*?\[]", place):
        base = re.split(r"[^/]*[*?\[]", place)[0]
        found = system.get_file_info(pyarrow.fs.FileSelector(base or "/", recursive=True, allow_not_found=True))
        pattern = re.compile("/".join(fnmatch.translate(x).removesuffix("\\Z").removesuffix("\\z").replace(".*", "[^/]*") for x in place.split("/")) + r"\Z")
        found = [f for f in found if pattern.match(f.path)]
    else:
        one = system.get_file_info(place)
        found = system.get_file_info(pyarrow.fs.FileSelector(place, recursive=True)) if one.type == pyarrow.fs.FileType.Directory else [one]
    files = sorted((f for f in found if f.type == pyarrow.fs.FileType.File and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
    if not files:
        raise FileNotFoundError(path)
    return system, files


class _Lines:
    """Lines of a file from a byte on, each with its place, and as much ahead as is asked for."""

    def __init__(self, stream, at: int) -> None:
        self.stream, self.at, self.rest, self.ahead, self.over = stream, at, b"", [], False

    def _more(self) -> bool:
        piece = b"" if self.over else self.stream.read(PIECE)
        self.over = self.over or not piece
        *whole, self.rest = (self.rest + piece).split(b"\n")
        if self.over and self.rest:
            whole, self.rest = [*whole, self.rest], b""
        for line in whole:
            self.ahead.append((self.at, line.rstrip()))
            self.at += len(line) + 1
        self.ahead.reverse()  # pop() takes the first
        return bool(whole) or not self.over

    def peek(self, n: int) -> list[tuple[int, bytes]]:
        while len(self.ahead) < n and not (self.over and not self.rest):
            self.ahead.reverse()
            self._more()
        return self.ahead[: -n - 1 : -1]

    def skip(self, n: int) -> None:
        del self.ahead[len(self.ahead) - n :]


def records(stream, start: int, end: int | None) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(offset, id, sequence, quality) of the records that begin from `start` on, before `end`; stream stands at `start`,
    or a byte before it where start is not 0.

    A record begins with a line that starts with @ and is followed, after another one, by a line that starts with +. An
    incomplete last record is dropped.
    """
    lines = _Lines(stream, max(0, start - 1))
    if start:
        lines.peek(1)
        lines.skip(1)  # what is left of the line before, or its end
        while (some := lines.peek(3)) and not (len(some) == 3 and some[0][1][:1] == b"@" and some[2][1][:1] == b"+"):
            lines.skip(1)
    while len(four := lines.peek(4)) == 4 and (end is None or four[0][0] < end):
        lines.skip(4)
        yield four[0][0], four[0][1], four[1][1], four[3][1]


class FastqReader(DataSourceReader):
    def __init__(self, path: str, size: int) -> None:
        self.path, self.size = path, size

    def partitions(self) -> list[InputPartition]:
        _, files = _listed(self.path)
        out = []
        for f in files:
            cuts = [0] if f.path.endswith(".gz") else range(0, max(1, f.size), self.size)
            out += [InputPartition((f.path, a, None if f.path.endswith(".gz") else a + self.size)) for a in cuts]
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, end = partition.value
        system = pyarrow.fs.FileSystem.from_uri(self.path.split("*")[0] if "://" in self.path else "file:///")[0]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        barcode = re.search("barcode[^/]*", path)
        with system.open_input_file(path) as raw:
            raw.seek(max(0, start - 1))
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
            held: list[tuple] = []
            for r in records(stream, start, end):
                held.append((path, barcode.group() if barcode else "", r[0], *(x.decode("utf-8", "replace") for x in r[1:])))
                if len(held) == RECORDS:
                    yield _batch(held, names)
                    held = []
            if held:
                yield _batch(held, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64() if n == "offset" else pa.string() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        size = int(self.options.get("splitBytes", SPLIT_BYTES))
        if size < 1:
            raise ValueError("splitBytes: 1 or more")
        return FastqReader(self.options["path"], size)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqSource)


def read_split_fastq(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, stop_at_empty: bool = True) -> DataFrame:
    """The records of FASTQ files by the data source; stop_at_empty ends a file at its first empty sequence, which takes
    a pass over the files of its own."""
    register(spark)
    df = spark.read.format("fastq").option("splitBytes", split_bytes).load(path)
    if not stop_at_empty:
        return df
    ends = df.filter("sequence = ''").groupBy(F.col("file").alias("_file")).agg(F.min("offset").alias("_stop"))
    return df.join(F.broadcast(ends), F.col("file") == F.col("_file"), "left").filter("_stop is null or offset < _stop").drop("_file", "_stop")
