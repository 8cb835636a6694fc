"""Completeness and distinct-value profiles, one pass over the data each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import MISSING_TEXTS, is_present
from ..functions.names import quoted


def _counts(df: DataFrame, missing_texts: Sequence[str]) -> DataFrame:
    """One row: the row count and, per column by position, how many values are present."""
    present = [F.count_if(is_present(c, t, missing_texts)).alias(f"c{i}") for i, (c, t) in enumerate(df.dtypes)]
    return df.agg(F.count(F.lit(1)).alias("total"), *present)


def _long(counts: DataFrame, df: DataFrame) -> DataFrame:
    """Turn the one row of counts into a row per column."""
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null_count"), F.lit(t).alias("dtype"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select("total", F.inline(F.array(*rows)))


def completeness_counts(df: DataFrame, missing_texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Per column: (column_name, valid_count)."""
    return _long(_counts(df, missing_texts), df).select("column_name", F.col("non_null_count").alias("valid_count"))


def missing_profile(
    df: DataFrame, missing_texts: Sequence[str] = MISSING_TEXTS, decimals: int = 2
) -> DataFrame:
    """Per column: missing count and percentage, present count and type; most complete first."""
    missing = F.col("total") - F.col("non_null_count")
    percentage = F.round(F.try_divide(missing, F.col("total")) * 100, decimals)
    return (
        _long(_counts(df, missing_texts), df)
        .select(
            "column_name",
            missing.alias("missing_count"),
            percentage.alias("missing_percentage"),
            "non_null_count",
            "dtype",
        )
        .orderBy("missing_percentage", "column_name")
    )


def _as_key(name: str, dtype: str) -> Column:
    """A value as text such that equal values, and only those, have equal text."""
    c = F.col(quoted(name))
    if dtype in ("double", "float"):
        c = c + F.lit(0.0).cast(dtype)  # -0.0 and 0.0 are one value
    if dtype == "binary":
        return F.base64(c)
    if dtype.startswith(("array", "map", "struct")):
        return F.to_json(c)
    return c.cast("string")


def distinct_profile(df: DataFrame, approximate: bool = False, rsd: float = 0.05) -> DataFrame:
    """Per column: (column_name, distinct_count), NULL not counted.

    Exact counting turns each row into narrow (column, value) pairs and drops repeats before the
    shuffle; the shuffle carries distinct values only. ``approximate=True`` needs no shuffle of
    values at all (relative error ``rsd``), for wide or high-cardinality tables.
    """
    if approximate:
        sketches = [F.approx_count_distinct(F.col(quoted(c)), rsd).alias(f"c{i}") for i, c in enumerate(df.columns)]
        rows = [
            F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("distinct_count"))
            for i, c in enumerate(df.columns)
        ]
        return df.agg(*sketches).select(F.inline(F.array(*rows)))
    pairs = [
        F.struct(F.lit(i).alias("position"), _as_key(c, t).alias("value")) for i, (c, t) in enumerate(df.dtypes)
    ]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .distinct()
        .groupBy("position")
        .agg(F.count("value").alias("distinct_count"))
    )
    # Fold the handful of counts back into one row, so that a column without values reads 0.
    folded = counts.agg(
        *[F.coalesce(F.max(F.when(F.col("position") == i, F.col("distinct_count"))), F.lit(0)).alias(f"c{i}")
          for i in range(len(df.columns))]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("distinct_count"))
        for i, c in enumerate(df.columns)
    ]
    return folded.select(F.inline(F.array(*rows)))


#: Bits of a stored distinct sketch: 2^12 counters, a relative standard error of some 1.6%.
SKETCH_BITS = 12


def profile_sketches(df: DataFrame, missing_texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Per column: (column_name, dtype, total, non_null_count, sketch), in one pass; ``sketch`` counts distinct values and can be
    merged with those of other datasets (``merged_profile``)."""
    kinds = df.dtypes
    sketches = [F.hll_sketch_agg(_as_key(c, t), SKETCH_BITS).alias(f"s{i}") for i, (c, t) in enumerate(kinds)]
    present = [F.count_if(is_present(c, t, missing_texts)).alias(f"c{i}") for i, (c, t) in enumerate(kinds)]
    counted = df.agg(F.count(F.lit(1)).alias("total"), *present, *sketches)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("dtype"), F.col(f"c{i}").alias("non_null_count"), F.col(f"s{i}").alias("sketch"))
        for i, (c, t) in enumerate(kinds)
    ]
    return counted.select("total", F.inline(F.array(*rows))).select("column_name", "dtype", "total", "non_null_count", "sketch")


def merged_profile(profiles: DataFrame, decimals: int = 2) -> DataFrame:
    """Profiles of several datasets (``dataset`` and the columns of ``profile_sketches``) as one, without reading their rows: counts are exact, distinct
    numbers estimates. A column that a dataset lacks is missing in all its rows. Columns without rows have a null percentage."""
    rows = profiles.groupBy("dataset").agg(F.max("total").alias("rows")).agg(F.sum("rows").alias("rows"))
    merged = profiles.groupBy("column_name").agg(
        F.sum("non_null_count").alias("non_null_count"), F.hll_union_agg("sketch").alias("sketch"), F.min("dtype").alias("dtype")
    )
    missing = F.col("rows") - F.col("non_null_count")
    # The number of rows is a single value.
    return merged.join(F.broadcast(rows), F.lit(True)).select(
        "column_name", missing.alias("missing_count"), F.round(F.try_divide(missing, F.col("rows")) * 100, decimals).alias("missing_percentage"),
        "non_null_count", F.hll_sketch_estimate("sketch").alias("distinct_estimate"), "dtype",
    )


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Grain values held by more than one row, with their row count."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def grain_key(df: DataFrame, grain: Sequence[str]) -> Column:
    """64 bits for the grain of a row, the same for equal values."""
    kinds = dict(df.dtypes)
    return F.xxhash64(*[F.col(quoted(c)) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(quoted(c)) for c in grain])


def repeated_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """As ``duplicate_grain``, for tables that repeat little: eight bytes of each row are shuffled to find candidates, and the
    values themselves only for these. Reads the grain columns twice."""
    key = grain_key(df, grain)
    some = df.groupBy(key.alias("_grain")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_grain")
    return duplicate_grain(df.join(some, key == F.col("_grain"), "left_semi"), grain)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quoted(c)) for c in columns]).distinct()
