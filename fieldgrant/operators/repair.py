"""Repair of rows whose cells slid into the neighbouring column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import quoted

# Fixed value: text that is an unsigned decimal number and nothing else.
NUMBER_TEXT = r"^\d+(\.\d+)?$"


def _is_number_text(date: str, date_digits: int | None) -> Column:
    c = F.col(quoted(date))
    looks = c.rlike(NUMBER_TEXT)
    # A yyyymmdd date is a number too; with date_digits=8 such a cell stays a date.
    return looks if date_digits is None else looks & ~c.rlike(rf"^\d{{{date_digits}}}$")


def shift_suspects(df: DataFrame, date: str, date_digits: int | None = None) -> DataFrame:
    """Rows whose date cell holds a number."""
    return df.filter(_is_number_text(date, date_digits))


def repair_shift(df: DataFrame, date: str, amount: str, date_digits: int | None = None) -> DataFrame:
    """Move a number found in ``date`` into an empty or zero ``amount`` and clear the date.

    The amount becomes the double of the moved text; unmoved amounts keep their value (and the
    column its type). With ``date_digits=8`` a cell of exactly 8 digits is left as a date.
    """
    value = F.col(quoted(amount))
    moved = _is_number_text(date, date_digits) & (value.isNull() | (value.try_cast("double") == 0.0))
    date_type, amount_type = df.schema[date].dataType, df.schema[amount].dataType
    shifted = F.col(quoted(date)).try_cast("double").cast(amount_type)
    return df.withColumns(
        {
            amount: F.when(moved, shifted).otherwise(value),
            date: F.when(moved, F.lit(None).cast(date_type)).otherwise(F.col(quoted(date))),
        }
    )


def shift_repaired_rows(df: DataFrame, date: str, amount: str) -> DataFrame:
    """Rows that look repaired: a positive amount and no date (NULL or the text ``None``)."""
    when = F.col(quoted(date))
    return df.filter((F.col(quoted(amount)).try_cast("double") > 0.0) & (when.isNull() | (when == "None")))
