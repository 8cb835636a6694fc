"""Tables kept as whole versions: a version is written to a folder of its own, then a pointer to it is appended."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or folders, in whatever store they are; one that is gone already is no error. Paths may be those that Spark
    reports, which are escaped URIs."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        there = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if "://" in path or path.startswith("file:") else path)
        there.getFileSystem(conf).delete(there, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


class Snapshots:
    """Versions of a table below ``path``. Readers see the latest published one; a writer that fails at any step leaves
    it as it was, and a version that was never published is never read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _pointers(self) -> DataFrame | None:
        path = f"{self.path}/pointers"
        return self.spark.read.schema("turn long, version string").parquet(path) if path_exists(self.spark, path) else None

    def version(self) -> str | None:
        """The version published last; of two that were published at once, one for all readers."""
        found = self._pointers()
        return None if found is None else found.agg(F.max(F.struct("turn", "version"))["version"]).first()[0]

    def folder(self, version: str) -> str:
        return f"{self.path}/versions/{version}"

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), version: str | None = None, name: str = "") -> str:
        """Write ``df`` as a version that nobody reads yet, or with a ``name`` as a table of ``version``."""
        version = version or uuid.uuid4().hex
        df.write.partitionBy(*partition_by).parquet(f"{self.folder(version)}/{name}")
        return version

    def publish(self, version: str) -> None:
        """Make a written version the one that is read. The pointer is one small file, which a store shows in whole or not at all."""
        found = self._pointers()
        turn = 0 if found is None else (found.agg(F.max("turn")).first()[0] or 0)
        one = self.spark.range(1).select(F.lit(turn + 1).cast("long").alias("turn"), F.lit(version).alias("version"))
        one.coalesce(1).write.mode("append").parquet(f"{self.path}/pointers")

    def read(self, schema: StructType | str, name: str = "", version: str | None = None) -> DataFrame | None:
        """The published version, or the one named, or its table ``name``; None before the first one."""
        version = version or self.version()
        return None if version is None else self.spark.read.schema(schema).parquet(f"{self.folder(version)}/{name}")

    def forget(self, keep: int = 1) -> None:
        """Delete all published versions but the ``keep`` latest ones. Nobody may be reading those any more."""
        found = self._pointers()
        if found is None:
            return
        old = [r["version"] for r in found.orderBy(F.desc("turn"), F.desc("version")).collect()[keep:]]
        delete_paths(self.spark, [self.folder(v) for v in old])
