"""Text helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def word_count(c: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)).cast("long"), F.lit(0))


def bounded(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``column`` (whole rows; a
    longer single value stands alone)."""
    for batch in batches:
        start, held = 0, 0
        sizes = [len(x) if x is not None else 0 for x in batch.column(column).cast(pa.large_binary()).to_pylist()]
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
