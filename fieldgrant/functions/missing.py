"""What counts as a missing value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import quoted

# Texts that stand for "no value" (compared after trimming, case-sensitive).
MISSING_TEXTS = ("", "N/A", "n/a", "NA", "na")


def is_present(name: str, dtype: str, missing_texts: Sequence[str] = MISSING_TEXTS) -> Column:
    """NULL is never present; floats must not be NaN; text must not be a missing-value marker."""
    c = F.col(quoted(name))
    present = c.isNotNull()
    if dtype in ("double", "float"):
        present = present & ~F.isnan(c)
    elif dtype == "string":
        present = present & ~F.trim(c).isin(*missing_texts)
    return present


def is_blank(name: str, trim: bool = False) -> Column:
    c = F.col(quoted(name))
    return (F.trim(c) if trim else c) == F.lit("")


def is_not_finite(name: str) -> Column:
    """True for both infinities and for NaN, which Spark orders above infinity."""
    return F.abs(F.col(quoted(name))) >= F.lit(float("inf"))
