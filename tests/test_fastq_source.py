"""The data source against the reader of whole files, at every size of split."""

import gzip
import io
import random

import pytest

from readloom.sources import fastq, files


def texts():
    """Files with qualities that begin with @ or +, empty lines, \\r\\n, a cut last record and no last newline."""
    rng = random.Random(1)

    def record(k, n, end="\n"):
        first = "@+I5"[k % 4]
        return f"@r{k} x{end}{''.join(rng.choices('ACGT', k=n))}{end}+{'r' if k % 3 else ''}{end}{(first + 'I' * n)[:n]}{end}"

    a = "".join(record(k, rng.randrange(1, 30)) for k in range(25))
    b = "".join(record(k, rng.randrange(1, 30), "\r\n") for k in range(9)) + "@cut\r\nACGT\r\n"
    c = "".join(record(k, 4) for k in range(5)) + "@empty\n\n+\n\n" + "".join(record(k, 4) for k in range(5, 9))
    return {"a": a, "b": b, "c": c, "d": "".join(record(k, 40) for k in range(3)).rstrip("\n"), "e": "", "f": "@only\nA\n"}


def test_every_split_has_each_record_once():
    for name, text in texts().items():
        data = text.encode()
        whole = list(fastq.records(io.BytesIO(data), 0, None))
        assert [r[0] for r in whole] == [i for i in range(len(data)) if any(r[0] == i for r in whole)] and all(data[r[0] :].startswith(r[1]) for r in whole)
        for size in [*range(1, 60), 97, 1000]:
            got = []
            for start in range(0, max(1, len(data)), size):
                stream = io.BytesIO(data)
                stream.seek(max(0, start - 1))
                got += fastq.records(stream, start, start + size)
            assert got == whole, (name, size)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("run")
    for k, (name, text) in enumerate(texts().items()):
        (top / f"barcode0{k % 2}").mkdir(exist_ok=True)
        (top / f"barcode0{k % 2}" / f"{name}.fastq").write_bytes(text.encode())
    (top / "barcode01" / "z.fastq.gz").write_bytes(gzip.compress(texts()["a"].encode()))
    (top / "barcode01" / "_ignored").write_text("x")
    return str(top)


def rows(df, order):
    return sorted((r["file"].split("/")[-1], r["barcode"], r[order], r["id"], r["sequence"], r["quality"]) for r in df.collect())


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
@pytest.mark.parametrize("stop", [True, False])
def test_same_as_whole_files(spark, folder, size, stop):
    got = rows(fastq.read_split_fastq(spark, f"{folder}/barcode*/*.fastq*", size, stop), "offset")
    want = rows(files.read_fastq(spark, f"{folder}/barcode*/*.fastq*", stop), "read_idx")
    assert [(r[0], r[1], *r[3:]) for r in got] == [(r[0], r[1], *r[3:]) for r in want] and len(got) > 60
    parts = spark.read.format("fastq").option("splitBytes", size).load(f"{folder}/barcode00")
    assert parts.rdd.getNumPartitions() >= (20 if size < 100 else 3) and parts.filter("file like '%gz'").count() == 0


def test_paths(spark, folder):
    fastq.register(spark)
    one = spark.read.format("fastq").load(f"file://{folder}/barcode00/a.fastq")
    assert one.count() == 25 and one.select("barcode").distinct().first()[0] == "barcode00"
    with pytest.raises(Exception, match="nothing"):
        spark.read.format("fastq").load(f"{folder}/nothing*").count()
