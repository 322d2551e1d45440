"""Tables written to the folder that driver and executors share, to cut lineage and keep plans small."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}
#: Folders written by materialize(), by application, in order.
_WRITTEN: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a new local folder where that is unset and the master is local (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(_OWN_DIR[app])
    return _OWN_DIR[app]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, every folder that materialize() has written inside: for work whose results are written
    elsewhere, or collected, before the end."""
    written = _WRITTEN.setdefault(spark.sparkContext.applicationId, [])
    before = len(written)
    try:
        yield
    finally:
        for path in written[before:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del written[before:]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back. The folder stays, unless it is written in scratch()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)
