"""Shared pieces of the training-data operators: shared storage, hot joins, text columns."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.sources.staging import materialize, shared_dir  # noqa: F401  for the operators

#: ASCII white space separates words; everything else belongs to a word (bytes.split() agrees).
WORD_GAP = r"[ \t-\r]+"
_SHIPPED: set[str] = set()
#: Bytes of rows that go to a Python worker at once; Spark's default of 64 MB is too much for texts of all sizes.
ARROW_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Make the session ready for Python tasks of this package: send it to the executors once per application, for
    clusters where the repository is not installed, and bound Arrow batches by ARROW_BYTES unless the user has set it."""
    import zipfile

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit).rstrip("b") == str(64 << 20):
        spark.conf.set(limit, str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(name: str, *taken: str) -> str:
    """A column name close to `name` that none of `taken` has, letter case aside."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of about `size` bytes that end at white space."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end]
        at = end


def give_back() -> None:
    """Return to the system what this Python process has freed: at a task's start what earlier tasks left in the worker,
    which Spark reuses, and in the driver what training took."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def places(kept: DataFrame, made: list[T.StructField]) -> list[str]:
    """Names by place for the columns of kept and those made."""
    return [f"c{k}" for k in range(len(kept.columns) + len(made))]


def with_columns(kept: DataFrame, made: list[T.StructField], run: Callable) -> DataFrame:
    """kept.mapInArrow(run) with the columns `made` appended. Inside, columns have names by place, so that none of the
    user's clashes with another."""
    fields, names = [*kept.schema.fields, *made], places(kept, made)
    inner = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)])
    return kept.toDF(*names[: len(kept.columns)]).mapInArrow(run, inner).toDF(*[f.name for f in fields])


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone, so that every engine agrees on the result."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_array(text: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")
