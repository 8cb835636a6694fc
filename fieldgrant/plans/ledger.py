"""The run ledger: an append-only table of run events, partitioned by stage.

A run appends one event; the current state is the latest event per key. Nothing is read, changed
and written back, so concurrent runs of different datasets cannot lose each other's records. Compaction publishes a snapshot of the
events beside the log and only then deletes what the snapshot holds; an event that is in both counts once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.snapshots import Snapshots, delete_paths

PROCESSED = "processed"
FAILED = "failed"

LEDGER_SCHEMA = (
    "dataset_id string, country string, year string, status string, fingerprint string, "
    "reason string, recorded_at timestamp, metadata map<string,string>, stage string"
)
KEY = ("stage", "dataset_id")


def latest_per_key(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Per key: when it was first and last seen (by the first ``order`` column) and the values of
    its latest event; later ``order`` columns break ties."""
    at = order[0]
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("_newest")
    return (
        events.groupBy(*keys)
        .agg(F.min(at).alias("created_at"), F.max(at).alias("updated_at"), newest)
        .select(*keys, "created_at", "updated_at", "_newest.*")
    )


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str], fingerprint: str = "fingerprint") -> DataFrame:
    """Wanted work that has no done record with the same fingerprint (NULL equals NULL)."""
    d = done.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(fingerprint).alias("_fingerprint")).alias("d")
    same: Column = F.col(fingerprint).eqNullSafe(F.col("_fingerprint"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return wanted.join(d, same, "left_anti")


def _once(events: DataFrame) -> DataFrame:
    """Events that are there twice as one."""
    values = F.struct(*[c for c in events.columns if c != "recorded_at"], F.unix_micros("recorded_at").alias("at"))
    return events.withColumn("_event", F.md5(F.to_json(values, {"ignoreNullFields": "false"}))).dropDuplicates(["_event"]).drop("_event")


class Ledger:
    """Run events at ``path``; the table is created where there is none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        # Folders with an underscore are no partitions of the log.
        self.snapshots = Snapshots(spark, f"{path}/_snapshots")
        none = spark.createDataFrame([], LEDGER_SCHEMA)
        none.write.mode("ignore").partitionBy("stage").parquet(path)

    def _append(
        self,
        stage: str,
        country: str,
        year: str,
        status: str,
        fingerprint: str | None,
        reason: str | None,
        metadata: Mapping[str, object] | None,
    ) -> None:
        country = country.upper()
        row = (
            f"{country}_{year}", country, year, status, fingerprint, reason,
            None, {k: str(v) for k, v in (metadata or {}).items()}, stage.upper(),
        )
        event = self.spark.createDataFrame([row], LEDGER_SCHEMA)
        event = event.withColumn("recorded_at", F.current_timestamp())
        event.write.mode("append").partitionBy("stage").parquet(self.path)

    def mark_processed(
        self,
        stage: str,
        country: str,
        year: str,
        fingerprint: str | None = None,
        metadata: Mapping[str, object] | None = None,
    ) -> None:
        self._append(stage, country, year, PROCESSED, fingerprint, None, metadata)

    def mark_failed(
        self,
        stage: str,
        country: str,
        year: str,
        reason: str,
        fingerprint: str | None = None,
        metadata: Mapping[str, object] | None = None,
    ) -> None:
        self._append(stage, country, year, FAILED, fingerprint, reason, metadata)

    def events(self, stage: str | None = None) -> DataFrame:
        """All run events, or those of one stage."""
        log = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        # The log was listed above: what has gone from it since is in the snapshot that is asked for now.
        held = self.snapshots.read(LEDGER_SCHEMA)
        if held is None:
            return log if stage is None else log.filter(F.col("stage") == stage.upper())
        both = log.unionByName(held)
        both = both if stage is None else both.filter(F.col("stage") == stage.upper())
        return _once(both)

    def current(self, stage: str | None = None) -> DataFrame:
        """The latest record per stage and dataset, with the time of its first one."""
        values = ("country", "year", "status", "fingerprint", "reason", "metadata")
        return latest_per_key(self.events(stage), KEY, ("recorded_at", "status"), values)

    def record(self, stage: str, country: str, year: str) -> DataFrame:
        """The record of one dataset: one row, or none."""
        return self.current(stage).filter(F.col("dataset_id") == f"{country.upper()}_{year}")

    def latest_processed(self, stage: str, country: str, year: str) -> str | None:
        """Fingerprint of the dataset's latest processed event, whatever failed since; None without one."""
        done = self.events(stage).filter(
            (F.col("dataset_id") == f"{country.upper()}_{year}") & (F.col("status") == PROCESSED)
        )
        return done.agg(F.max_by("fingerprint", "recorded_at")).first()[0]

    def compact(self) -> None:
        """Gather the events in one snapshot, a file per stage, and delete their files. Runs may append meanwhile: their events stay in the
        log. If it stops at any point, no event is lost and none counts twice."""
        log = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        files = log.inputFiles()
        held = self.snapshots.read(LEDGER_SCHEMA)
        events = log if held is None else _once(log.unionByName(held))
        self.snapshots.publish(self.snapshots.write(events.repartition("stage"), ["stage"]))
        delete_paths(self.spark, files)
        self.snapshots.forget(keep=2)  # a reader may still be at the one before

    def is_processed(self, stage: str, country: str, year: str, fingerprint: str | None = None) -> bool:
        done = self.record(stage, country, year).filter(
            (F.col("status") == PROCESSED) & F.col("fingerprint").eqNullSafe(F.lit(fingerprint))
        )
        return not done.isEmpty()

    def pending(self, wanted: DataFrame, stage: str) -> DataFrame:
        """Rows of ``wanted`` (dataset_id, fingerprint, …) not yet processed at this fingerprint."""
        done = self.current(stage).filter(F.col("status") == PROCESSED)
        return pending(wanted, done, ("dataset_id",))
