"""Column profiles kept per dataset and merged for any set of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import merged_profile, profile_sketches
from ..sources.sinks import write_partitioned

_SCHEMA = "column_name string, dtype string, total long, non_null_count long, sketch binary, dataset string"


class ProfileStore:
    """One small Parquet partition per dataset at ``path``; a dataset's is replaced when the dataset is."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, dataset: str, rows: DataFrame) -> None:
        profile = profile_sketches(rows).withColumn("dataset", F.lit(dataset))
        write_partitioned(profile.coalesce(1), self.path, ["dataset"])

    def profile(self, datasets: Sequence[str] | None = None) -> DataFrame:
        """The profile of all recorded datasets, or of those named, as of one table of their rows."""
        held = self.spark.read.schema(_SCHEMA).parquet(self.path)
        return merged_profile(held if datasets is None else held.filter(F.col("dataset").isin(*datasets)))
