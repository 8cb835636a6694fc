"""A layout of silver rows by beneficiary, which merge, totals, pivot and master table share without a shuffle of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import payments
from ..spec import AMOUNT_COLUMNS
from ..taxonomy import SCHEMES, Scheme
from .master import build_master, build_master_join

LAYOUT = (*payments.MERGE_KEYS, *AMOUNT_COLUMNS, *payments.REPRESENTATIVES)


#: Rows that a bucket is to hold: some 500 MB in the aggregations of the task that reads it.
BUCKET_ROWS = 250_000


def buckets_for(silver: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """A number of buckets that grows with the table, so that none needs more memory as there are more beneficiaries. Counts the rows."""
    return max(least, -(-silver.count() // rows))


def layout_rows(silver: DataFrame, heavy: Sequence[int] | None = None) -> DataFrame:
    """The rows that the layout holds: those of identifiable beneficiaries, with the payments of each heavy beneficiary merged to one row per
    scheme, so that no bucket is filled by one of them. ``heavy``: xxhash64 of these, told by a sketch if not given."""
    rows = payments.identifiable_payouts(silver).select(*LAYOUT)
    heavy = payments.heavy_keys(rows, ["beneficiary"]) if heavy is None else list(heavy)
    if not heavy:
        return rows
    among = F.xxhash64("beneficiary").isin(heavy)
    merged = payments.merge_payments_salted(rows.filter(among)).select(*LAYOUT)
    return rows.filter(~among).union(merged)


def write_layout(silver: DataFrame, table: str, path: str, buckets: int, heavy: Sequence[int] | None = None) -> None:
    """Write the layout as the table ``table`` at ``path``: one shuffle by beneficiary, one file per bucket. Choose ``buckets`` so that
    one is read by one task (``buckets_for``). An existing table is replaced."""
    rows = layout_rows(silver, heavy).repartition(buckets, "beneficiary")
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, "beneficiary").sortBy("beneficiary", "intervention_code").saveAsTable(table)


def bucketed_master(spark: SparkSession, table: str, schemes: Sequence[Scheme] = SCHEMES, join: bool = False) -> DataFrame:
    """The wide beneficiary table from the layout, without a shuffle; ``join=True`` as macro totals joined with the pivot."""
    return (build_master_join if join else build_master)(spark.table(table), schemes)
