"""Running sums over the lines of files that Spark reads in blocks: sums per block first, running sums of these, then of the lines in a block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: What tells a block: its file, and where in it the block starts.
BLOCK = ("path", "start")


def block_columns() -> tuple[Column, Column, Column]:
    """path, start and line of each row of a text scan; ``line`` orders the rows of a block, which one task reads."""
    path, start = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    return path, start, F.monotonically_increasing_id().alias("line")


def earlier(blocks: DataFrame, total: Column, name: str) -> DataFrame:
    """(path, start, name): ``total`` over the earlier blocks of the same file; null for a file's first. There is one row per block, not per line."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*BLOCK, total.over(before).alias(name))


def up_to(*order: str, last: int = 0) -> WindowSpec:
    """The rows of a block up to the current one, or to the one before it (``last=-1``)."""
    return Window.partitionBy(*BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
