"""Shaping landed data: provenance, union, header promotion, mapping and fills."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from ..functions.names import quoted, unique_names
from ..spec import AMOUNT_COLUMNS, AUDIT_COLUMN, PROVENANCE_COLUMNS, TEXT_COLUMNS, UNKNOWN_TEXT, DatasetSpec


def as_text(df: DataFrame) -> DataFrame:
    """Every column as string (nested values as JSON), so that frames of different origin unite
    without a run-time cast failure."""

    def text(field) -> Column:
        c = F.col(quoted(field.name))
        if isinstance(field.dataType, (StructType, ArrayType, MapType)):
            return F.to_json(c).alias(field.name)
        if isinstance(field.dataType, StringType):
            return c
        return c.cast("string").alias(field.name)

    return df.select(*[text(f) for f in df.schema.fields])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, NULL where a frame lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stamp_provenance(df: DataFrame, country: str, year: str, at: Column | None = None) -> DataFrame:
    """Add source_country, source_year and ingested_at."""
    return df.withColumns(
        {
            "source_country": F.lit(country),
            "source_year": F.lit(year),
            "ingested_at": F.current_timestamp() if at is None else at,
        }
    )


def promote_header(df: DataFrame, anchor: str, keep_null_rows: bool = False) -> DataFrame:
    """Use a data row as header: the row whose first data column equals ``anchor``.

    The row is found by content, so it does not matter which file or task holds it. Header rows
    are dropped; rows with NULL in the first column go with them unless ``keep_null_rows``.
    Header rows of several files must agree: a column holds one thing in all of them.
    Cells without text in the header row keep their old name; provenance columns are left alone.
    """
    data = [c for c in df.columns if c not in PROVENANCE_COLUMNS]
    first = F.col(quoted(data[0]))
    headers = df.select(*[F.col(quoted(c)) for c in data]).filter(first == anchor).distinct().limit(2).collect()
    if not headers:
        raise ValueError(f"no row starts with {anchor!r}")
    if len(headers) > 1:
        raise ValueError(f"rows that start with {anchor!r} name different columns")
    header = headers[0]
    promoted = iter(unique_names([str(new) if new is not None else old for old, new in zip(data, header)]))
    is_data = first != anchor
    if keep_null_rows:
        is_data = is_data | first.isNull()
    return df.filter(is_data).toDF(*[c if c in PROVENANCE_COLUMNS else next(promoted) for c in df.columns])


def map_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The spec's columns, in spec order, in one projection."""
    return df.select(*[field.expression(df.columns) for field in spec.fields])


def fill_missing(
    df: DataFrame,
    text_columns: Sequence[str] = TEXT_COLUMNS,
    amount_columns: Sequence[str] = AMOUNT_COLUMNS,
) -> DataFrame:
    """NULL text becomes UNKNOWN; NULL and NaN amounts become 0. Empty text is left as it is."""
    return df.fillna(UNKNOWN_TEXT, list(text_columns)).fillna(0.0, list(amount_columns))


def stamp_silver(df: DataFrame, at: Column | None = None) -> DataFrame:
    return df.withColumn(AUDIT_COLUMN, F.current_timestamp() if at is None else at)


def to_silver(df: DataFrame, spec: DatasetSpec, at: Column | None = None) -> DataFrame:
    """Bronze rows of one dataset in the silver contract (prepare, map, fill, stamp)."""
    prepared = df if spec.prepare is None else df.transform(spec.prepare)
    return prepared.transform(map_columns, spec).transform(fill_missing).transform(stamp_silver, at)
