"""What has landed: file inventory, file fingerprints, and file links on web pages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links
from ..functions.fingerprints import summed
from .blocks import BLOCK, block_columns, earlier, up_to
from .readers import SCANNABLE

# Suffixes that make a landed file a data file (any of a name's suffixes counts).
DATA_SUFFIXES = ("csv", "xlsx", "xls", "parquet", "json", "txt")

# Suffixes of a spreadsheet offered for download.
SPREADSHEET_SUFFIXES = (".xlsx", ".xls")


def _landed(spark: SparkSession, root: str, suffixes: Sequence[str]) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.withColumn("file_name", name).filter(
        F.col("file_name").rlike(rf"(?i)^.+\.({'|'.join(suffixes)})(\.[^/]*)?$")
    )


def inventory(spark: SparkSession, root: str, suffixes: Sequence[str] = DATA_SUFFIXES) -> DataFrame:
    """Data files below ``root``: (path, file_name, length, modified_at). File content is not read."""
    return _landed(spark, root, suffixes).select(
        "path", "file_name", "length", F.col("modificationTime").alias("modified_at")
    )


#: Bytes up to which a file is digested whole, by one task.
WHOLE_FILE = 1 << 30


def file_fingerprints(spark: SparkSession, root: str, suffixes: Sequence[str] = DATA_SUFFIXES, whole: int = WHOLE_FILE) -> DataFrame:
    """MD5 of each data file's bytes; of files of more than ``whole`` bytes, the digest that ``content_fingerprints`` gives.

    An MD5 takes a file's bytes one after the other, and Spark holds a file as one row of at most 2 GB, so only smaller files are read that way."""
    landed = _landed(spark, root, suffixes)
    small = landed.filter(F.col("length") <= whole).select("path", "file_name", "length", F.md5("content").alias("fingerprint"))
    if landed.filter(F.col("length") > whole).select("path").isEmpty():
        return small
    return small.unionByName(content_fingerprints(spark, root, suffixes, larger=whole))


def content_fingerprints(spark: SparkSession, root: str, suffixes: Sequence[str] = DATA_SUFFIXES, larger: int = -1) -> DataFrame:
    """A digest of each data file's bytes, for files of any size (of more than ``larger`` bytes): (path, file_name, length, fingerprint).

    A file is read in as many tasks as Spark splits it into, piece by piece (a piece ends with a line feed). Each piece's MD5 is digested again
    with the piece's place in the file, and these digests are added up, so the result doesn't depend on how the file was split. Only
    digests are shuffled. Files compressed by line (gz, bz2) are read as their content; a piece is at most 2 GB.
    """
    files = inventory(spark, root, suffixes).filter(F.col("length") > larger)
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root)
    wanted = rf"(?i)^.+\.({'|'.join(suffixes)})(\.[^/]*)?$"
    piece = F.col("value").cast("binary")
    rows = text.filter(F.col("_metadata.file_name").rlike(wanted) & (F.col("_metadata.file_size") > larger))
    rows = rows.select(*block_columns(), F.md5(piece).alias("digest"), (F.octet_length(piece) + 1).cast("long").alias("size"))
    before = earlier(rows.groupBy(*BLOCK).agg(F.sum("size").alias("n")), F.sum("n"), "before")
    place = F.coalesce("before", F.lit(0)) + F.coalesce(F.sum("size").over(up_to("line", last=-1)), F.lit(0))
    placed = rows.join(before, list(BLOCK)).select("path", F.md5(F.concat(place.cast("string"), F.lit(":"), "digest").cast("binary")).alias("digest"))
    found = placed.groupBy(F.col("path").alias("_path")).agg(summed(F.col("digest")).alias("fingerprint"))
    # Files without bytes have no pieces.
    both = files.join(found, F.col("path") == F.col("_path"), "left").drop("_path", "modified_at")
    return both.withColumn("fingerprint", F.coalesce("fingerprint", F.lit("0-0-0-0")))


def landing_fingerprint(files: DataFrame, root: str = "") -> DataFrame:
    """One row for an inventory: (file_count, byte_count, fingerprint) of the files' paths below ``root``, lengths and times of change.

    The times are counted in microseconds, so the session's time zone doesn't matter.
    """
    below = F.regexp_replace("path", r"^.*?" + re.escape(root.rstrip("/").rsplit("/", 1)[-1]) + "/", "") if root else F.col("path")
    told = F.concat(F.length(below), F.lit(":"), below, F.lit("|"), "length", F.lit("|"), F.unix_micros("modified_at"))
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("byte_count"),
        summed(F.md5(told.cast("binary"))).alias("fingerprint"),
    )


def dataset_inventory(spark: SparkSession, landing_root: str, country: str, year: str) -> DataFrame | None:
    """Data files of one dataset, below ``<country>/<year>_LANDING``; None where nothing has landed."""
    try:
        return inventory(spark, f"{landing_root}/{country}/{year}_LANDING")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def landed_paths(files: DataFrame) -> tuple[list[str], list[str]]:
    """Paths of the inventory's files that Spark can scan, and of the data files it cannot (spreadsheets, backups), in order.
    One short text per file comes to the driver, which names them to the readers."""
    listed = files.select("path", F.col("file_name").rlike(SCANNABLE).alias("scannable")).orderBy("path")
    found = [(r.path, r.scannable) for r in listed.collect()]
    return [p for p, ok in found if ok], [p for p, ok in found if not ok]


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per anchor: (key, position, link), in document order.

    Exploding with outer semantics and dropping the empty rows afterwards keeps Spark from
    evaluating the extraction twice, once more as a filter for pages without links.
    """
    found = pages.select(key, F.posexplode_outer(links.hrefs(F.col(html))).alias("position", "link"))
    return found.filter(F.col("link").isNotNull())


def first_matching_link(
    pages: DataFrame,
    contains: str,
    any_of: Sequence[str] = SPREADSHEET_SUFFIXES,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Per page, the address of the first link that names ``contains`` and one of ``any_of``.

    Pages without such a link are left out; ``require_link`` turns that into an error.
    """
    first = links.first_href(links.hrefs(F.col(html)), contains, any_of)
    return (
        pages.select(key, F.col(url).alias("_base"), F.explode_outer(F.array(first)).alias("_href"))
        .filter(F.col("_href").isNotNull())
        .select(key, links.absolute_url(F.col("_base"), F.col("_href")).alias("link"))
    )


def require_link(
    pages: DataFrame,
    contains: str,
    any_of: Sequence[str] = SPREADSHEET_SUFFIXES,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """As ``first_matching_link``, but a page without a match fails the query."""
    first = links.first_href(links.hrefs(F.col(html)), contains, any_of)
    missing = F.raise_error(F.concat(F.lit(f"no link for {contains} on "), F.col(url)))
    return pages.select(
        key,
        F.when(first.isNull(), missing).otherwise(links.absolute_url(F.col(url), first)).alias("link"),
    )
