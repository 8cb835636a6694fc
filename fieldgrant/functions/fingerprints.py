"""Content fingerprints that do not depend on row order or on how a dataset is split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import quoted


def row_digest(df: DataFrame) -> Column:
    """MD5 of a row's values. Each is written with its length, NULL as a sign of its own, so that
    different rows never give the same text."""

    def told(c: str) -> Column:
        text = F.col(quoted(c)).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.md5(F.concat(*[told(c) for c in df.columns]).cast("binary"))


def summed(digest: Column) -> Column:
    """Sum of hexadecimal 128-bit digests, as the sums of their four 32-bit words: whole digests count, and the sums
    have room for any number of rows."""
    words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(10,0)") for i in range(4)]
    sums = [F.coalesce(F.sum(w.cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")).cast("string") for w in words]
    return F.concat_ws("-", *sums)


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """One row: (row_count, fingerprint).

    The fingerprint adds up the row digests, so each task contributes four numbers, whatever the
    size of the dataset or of its files.
    """
    return df.agg(F.count(F.lit(1)).alias("row_count"), summed(row_digest(df)).alias("fingerprint"))
