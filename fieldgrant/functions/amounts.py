"""Parsing and summing money.

Amount text is parsed with ``try_cast``: text that is no number becomes NULL instead of
failing the job under ANSI mode. Sums are taken in whole cents, so a result does not depend on
the order in which tasks finish or on a retried task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import quoted

def _column(c: Column | str) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def plain_amount(c: Column | str) -> Column:
    """Decimal-point text to double; anything else is NULL."""
    return _column(c).try_cast("double")


def comma_amount(c: Column | str, thousands_sep: str | None = None) -> Column:
    """Decimal-comma text to double.

    By default only the comma is replaced, so ``1.234,56`` is no number and yields NULL.
    ``thousands_sep="."`` removes that separator first and yields 1234.56.
    """
    text = _column(c)
    if thousands_sep:
        text = F.replace(text, F.lit(thousands_sep), F.lit(""))
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def parse_failed(raw: Column | str, parsed: Column) -> Column:
    """True where a value was given but did not parse: money that a zero fill would hide."""
    text = _column(raw)
    return text.isNotNull() & (F.trim(text) != "") & parsed.isNull()


def cents(c: Column) -> Column:
    """A double amount in cents, snapped to the whole cent it stands for.

    A value within a millionth of a cent (or a few rounding errors) of a whole cent *is* that
    cent; sub-cent values, NaN and infinities stay as they are.
    """
    scaled = c * F.lit(100.0)
    whole = F.rint(scaled)
    tolerance = F.lit(1e-6) + F.abs(scaled) * F.lit(1e-15)
    return F.when(F.abs(scaled - whole) < tolerance, whole).otherwise(scaled)


def exact_sum(c: Column | str, where: Column | None = None) -> Column:
    """Sum of a double column (NULL when there is nothing to add).

    Whole cents add up without rounding in a double, in any order, up to 2**53 cents (90 trillion
    units). Beyond that, or with sub-cent values, this is an ordinary double sum.
    """
    amount = cents(_column(c))
    return F.sum(amount if where is None else F.when(where, amount)) / F.lit(100.0)
