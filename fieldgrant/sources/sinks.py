"""Bronze and silver tables: Parquet partitioned by dataset, replaced one dataset at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..spec import PROVENANCE_COLUMNS, SILVER_SCHEMA
from .readers import read_parquet
from .scratch import WRITERS as _WRITERS
from .scratch import unsorted as _unsorted

BRONZE_PARTITIONS = ("source_country", "source_year")
SILVER_PARTITIONS = ("country", "year")


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    rebalance: bool = False,
    max_records_per_file: int = 0,
) -> None:
    """Replace exactly the partitions present in ``df``; a failed job leaves the old files.

    ``rebalance=True`` shuffles into evenly sized files per partition value and lets adaptive
    execution split a value that holds most of the rows. Leave it off when ``df`` is one dataset:
    its scan tasks already write well-sized files and the shuffle would buy nothing.
    """
    out = df.hint("rebalance", *partitions) if rebalance else df
    with _unsorted(df.sparkSession):
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*partitions)
            .parquet(path)
        )


def write_bronze(df: DataFrame, path: str, rebalance: bool = False) -> None:
    write_partitioned(df, path, BRONZE_PARTITIONS, rebalance)


def replace_bronze(df: DataFrame, path: str, country: str, year: str) -> int:
    """Replace one dataset of the bronze table, also by nothing, and give its number of rows."""
    counted = Observation()
    write_bronze(df.observe(counted, F.count(F.lit(1)).alias("rows")), path)
    rows = counted.get["rows"]
    if not rows:
        # A dynamic overwrite replaces only partitions that it writes to.
        empty = df.drop(*BRONZE_PARTITIONS)
        empty.write.mode("overwrite").parquet(f"{path}/source_country={country}/source_year={year}")
    return rows


def write_silver(df: DataFrame, path: str, rebalance: bool = False) -> None:
    write_partitioned(df, path, SILVER_PARTITIONS, rebalance)


def read_bronze(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The bronze table. Datasets differ in columns, so name the ``columns`` wanted where known;
    otherwise the footers are merged. Partition values stay text (a year is not a number)."""
    if columns is None:
        merged = spark.read.option("mergeSchema", "true").parquet(path).schema
        kinds = {f.name: f.dataType for f in merged.fields}
        fields = [StructField(n, StringType() if n in BRONZE_PARTITIONS else t) for n, t in kinds.items()]
    else:
        fields = [StructField(c, StringType()) for c in columns if c not in PROVENANCE_COLUMNS]
        fields += [StructField(n, t) for n, t in PROVENANCE_COLUMNS.items()]
    return read_parquet(spark, path, StructType(fields))


def read_bronze_dataset(spark: SparkSession, path: str, country: str, year: str) -> DataFrame:
    """One dataset of the bronze table: only its directory is listed, with only its own columns."""
    rows = spark.read.parquet(f"{path}/source_country={country}/source_year={year}")
    return rows.withColumns({"source_country": F.lit(country), "source_year": F.lit(year)})


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The silver table, all datasets, in contract order."""
    return read_parquet(spark, path, SILVER_SCHEMA).select(*SILVER_SCHEMA.names)
