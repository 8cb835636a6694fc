"""Where intermediate tables go: the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(1)
def _local_root() -> str:
    folder = tempfile.mkdtemp(prefix="fieldgrant-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session without one gets a temporary folder of its own, removed when
    Python ends; a cluster session must name a folder that all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch root that no other run uses."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so that several consumers share one computation that
    survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    (df.write if compression is None else df.write.option("compression", compression)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted(spark: SparkSession, values: int = 1) -> Iterator[None]:
    """Let a task write its first ``values`` partition values as it reads them. Spark would sort the task's rows by partition otherwise, which
    for so few changes nothing and holds them in memory; rows of further values are sorted still."""
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, max(int(before or 0), values))
    try:
        yield
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs whose results are written. It does so when the driver collects garbage, which may be much
    later: a long chain of stages would hold all of them until then."""
    spark._jvm.System.gc()


def discard(table: DataFrame) -> None:
    """Delete a materialised table that nothing will read again."""
    from .snapshots import delete_paths

    delete_paths(table.sparkSession, sorted({f.rsplit("/", 1)[0] for f in table.inputFiles()}))
