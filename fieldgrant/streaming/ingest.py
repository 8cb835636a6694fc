"""Landing to bronze as an incremental file stream.

The stream's checkpoint remembers which files were ingested, so every run picks up exactly the
files that landed since the last one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.names import normalise_columns
from ..operators.shape import stamp_provenance
from ..sources.readers import DELIMITED_OPTIONS, charset
from ..plans.bronze import STAGE
from ..plans.ledger import Ledger
from ..sources.sinks import BRONZE_PARTITIONS, read_bronze_dataset, replace_bronze


def landed_stream(
    spark: SparkSession,
    landing: str,
    header: list[str],
    country: str,
    year: str,
    delimiter: str = ";",
    encoding: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Delimited files with a known ``header`` as a stream of bronze rows. A file whose header
    differs fails the batch."""
    reader = (
        spark.readStream.schema(StructType([StructField(c, StringType()) for c in header]))
        .options(**DELIMITED_OPTIONS)
        .options(delimiter=delimiter, encoding=charset(encoding), enforceSchema="false")
        .option("recursiveFileLookup", "true")
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return stamp_provenance(normalise_columns(reader.csv(landing)), country, year)


def ingest_available(
    rows: DataFrame, bronze_path: str, checkpoint: str, ledger: Ledger, country: str, year: str
) -> StreamingQuery:
    """Bring everything that has landed so far into one dataset of the bronze table, each file exactly once, and stop.

    The first batch of a checkpoint replaces the dataset, later ones add to it. A batch marks its rows in ``ingest_batch``, so
    one that is tried again after its write adds nothing. Each batch leaves a ledger event whose fingerprint follows from that
    of the last one, so later stages see new data. If a batch run has replaced the dataset meanwhile, its files may have been
    taken already: the stream fails and asks for a new checkpoint.
    """
    spark = rows.sparkSession
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def take(batch: DataFrame, number: int) -> None:
        mark = f"{stream}-{number}"
        last = ledger.latest_processed(STAGE, country, year)
        if number and not (last or "").startswith(stream):
            raise RuntimeError("a batch run has replaced the dataset: start the stream with a new checkpoint")
        if last == _fingerprint(stream, number):
            return
        marked = batch.withColumn("ingest_batch", F.lit(mark))
        if not number:
            count = replace_bronze(marked, bronze_path, country, year)
        else:
            held = read_bronze_dataset(spark, bronze_path, country, year)
            count = None
            if "ingest_batch" not in held.columns or held.filter(F.col("ingest_batch") == mark).isEmpty():
                counted = Observation()
                seen = marked.observe(counted, F.count(F.lit(1)).alias("rows"))
                seen.write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(bronze_path)
                count = counted.get["rows"]
        ledger.mark_processed(STAGE, country, year, _fingerprint(stream, number), {"batch": number, "rows": count})

    return (
        rows.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _fingerprint(stream: str, number: int) -> str:
    return f"{stream}:{number}"
