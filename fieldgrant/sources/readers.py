"""Scans of landed files: delimited text, JSON, Parquet."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import normalise_columns, normalise_name, quoted, unique_names
from ..operators.shape import as_text, union_by_name
from .blocks import block_columns
from .json_scan import as_lines

# Formats that can be scanned, by file suffix.
DELIMITED_SUFFIXES = (".csv", ".txt")
SCANNABLE_SUFFIXES = (".csv", ".txt", ".json", ".parquet")
#: Compressed text files that Spark reads as it reads plain ones (a file is one task then).
COMPRESSED_SUFFIXES = (".gz", ".bz2", ".deflate")
#: Names of files that can be scanned.
SCANNABLE = r"(?i)\.(parquet|(csv|txt|json)(\.(gz|bz2|deflate))?)$"

# Encoding labels found in source catalogs -> charset names Spark accepts.
CHARSETS = {
    "latin-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "iso-88591": "ISO-8859-1",
    "utf-8": "UTF-8",
}

# How delimited files are parsed. No type inference: every column is text.
DELIMITED_OPTIONS = {
    "header": "true",
    "multiLine": "false",
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "maxColumns": "10000",
}

#: Spark's column for text that it could not parse, and the one that ``read_landed`` gives it as.
CORRUPT, BROKEN = "_corrupt_record", "broken record text"

Paths = str | Sequence[str]


def file_suffix(path: str) -> str:
    """The suffix that tells the format: ``.csv`` for ``a.CSV.gz``."""
    suffixes = [s.lower() for s in PurePosixPath(path).suffixes]
    if len(suffixes) > 1 and suffixes[-1] in COMPRESSED_SUFFIXES:
        return suffixes[-2]
    return suffixes[-1] if suffixes else ""


def charset(label: str | None) -> str:
    """Spark charset for a catalog's encoding label; ISO-8859-1 where none is given."""
    return CHARSETS.get((label or "iso-8859-1").strip().lower(), label)


def read_delimited(
    spark: SparkSession,
    paths: Paths,
    delimiter: str = ";",
    encoding: str | None = None,
    same_header: bool = False,
) -> DataFrame:
    """One scan of delimited files that share a header.

    ``same_header=True`` makes every task check the header of the files it opens against the
    first one and fail on a difference, instead of reading columns by position.
    """
    reader = spark.read.options(**DELIMITED_OPTIONS).options(delimiter=delimiter, encoding=charset(encoding))
    if same_header:
        reader = reader.option("enforceSchema", "false")
    return reader.csv(_as_list(paths))


def read_json(
    spark: SparkSession,
    paths: Paths,
    schema: StructType | str | None = None,
    lines: bool = False,
) -> DataFrame:
    """JSON files known to hold one document each (a value or an array), or with ``lines=True`` one object per line.

    Of a file with several documents over several lines only the first would be read: use ``read_json_any`` for files that
    aren't known. Passing ``schema`` saves the inference pass over the files.
    """
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema is not None else reader).json(_as_list(paths))


def read_parquet(spark: SparkSession, paths: Paths, schema: StructType | str | None = None) -> DataFrame:
    """Parquet files; an explicit ``schema`` keeps partition values such as a year as text."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*_as_list(paths))


def read_json_any(spark: SparkSession, paths: Paths, lines: bool | None = None) -> DataFrame:
    """JSON files of any shape: values on lines, documents over several lines, arrays of records, any number of each in a file.

    Text that is no record comes as a row of its own, with nothing but that text in ``_corrupt_record``. A record is held by one
    task, a file need not be. ``lines=True`` says that every file holds one value per line and saves telling them apart.
    """
    found = _as_list(paths) if lines else as_lines(spark, _as_list(paths))
    if not found:
        return spark.createDataFrame([], StructType())
    return read_json(spark, found, lines=True)


def read_files(
    spark: SparkSession,
    paths: Paths,
    suffix: str,
    delimiter: str = ";",
    encoding: str | None = None,
    same_header: bool = False,
    json_lines: bool | None = None,
) -> DataFrame:
    """Scan files of one format, chosen by suffix. ``json_lines`` says that JSON files hold one value per line; by default their shape is
    told from the files."""
    suffix = suffix.lower()
    if suffix in DELIMITED_SUFFIXES:
        return read_delimited(spark, paths, delimiter, encoding, same_header)
    if suffix == ".json":
        return read_json_any(spark, paths, json_lines)
    if suffix == ".parquet":
        return read_parquet(spark, paths)
    raise ValueError(f"cannot scan files of type {suffix!r}")


#: Files up to which the places of columns are sent to all tasks: one row per file.
BROADCAST_FILES = 200_000


def _headers(spark: SparkSession, paths: Sequence[str], encoding: str | None) -> dict[str, str]:
    """First line with text of each file that has one, by the path that Spark tells of it; one job however many files there are.

    The lines' numbers are compared first and only the lines found are taken then: a minimum of texts would sort all lines of the blocks."""
    text = spark.read.text(list(paths)).select(*block_columns(), "value").filter((F.col("start") == 0) & (F.trim("value") != ""))
    first = text.groupBy("path").agg(F.min("line").alias("line"))
    header = text.join(F.broadcast(first) if len(paths) <= BROADCAST_FILES else first, ["path", "line"])
    # The text scan keeps a file's bytes.
    found = header.select("path", F.col("value").cast("binary").alias("header")).orderBy("path").collect()
    return {r["path"]: bytes(r["header"]).decode(charset(encoding), "replace") for r in found}


def header_names(header: str, delimiter: str = ";") -> list[str]:
    """Column names of a header line, normalised, as the delimited scan tells them: a column without a name has its number, a repeated
    name gets it appended."""
    if len(delimiter) > 1:
        cells = [c.strip('"') for c in header.split(delimiter)]
    else:
        cells = next(csv.reader([header], delimiter=delimiter, escapechar="\\", skipinitialspace=True), [])
    names = [c.strip() for c in cells]
    seen = Counter(n.lower() for n in names)
    safe = [f"_c{i}" if not n else f"{n}{i}" if seen[n.lower()] > 1 else n for i, n in enumerate(names)]
    return unique_names([normalise_name(n) for n in safe])


def read_headed(spark: SparkSession, paths: Paths, delimiter: str = ";", encoding: str | None = None) -> DataFrame:
    """Delimited files, each with a header of its own, as one frame of all their columns (normalised names, NULL where a file lacks one).

    One job finds the headers; one scan reads all files by position, and each row picks its columns from the places that its file's
    header tells, so the plan is the same for two headers and for thousands.
    """
    paths = _as_list(paths)
    told = _headers(spark, paths, encoding)
    columns = {h: header_names(h, delimiter) for h in dict.fromkeys(told.values())}
    if len(columns) < 2:
        return normalise_columns(read_delimited(spark, paths, delimiter, encoding, same_header=True))
    names = list(dict.fromkeys(n for own in columns.values() for n in own))
    places = {h: [own.index(n) if n in own else -1 for n in names] for h, own in columns.items()}
    files = spark.createDataFrame([(p, places[h]) for p, h in told.items()], "_path string, _places array<int>")
    cells = [f"c{i}" for i in range(max(map(len, columns.values())))]
    reader = spark.read.options(**DELIMITED_OPTIONS).options(delimiter=delimiter, encoding=charset(encoding))
    rows = reader.schema(", ".join(f"{c} string" for c in cells)).csv(paths)
    rows = rows.select(F.col("_metadata.file_path").alias("_path"), F.array(*cells).alias("_cells"))
    rows = rows.join(F.broadcast(files) if len(told) <= BROADCAST_FILES else files, "_path")
    return rows.select(*[F.get("_cells", F.get("_places", F.lit(j))).alias(n) for j, n in enumerate(names)])


def _parquet_frames(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """One scan with all columns of all files; files whose types can't be merged are read one by one."""
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*paths)]
    except Exception as e:
        if "CANNOT_MERGE" not in str(e):
            raise
        return [read_parquet(spark, p) for p in paths]


def read_landed(
    spark: SparkSession,
    files: Sequence[str],
    delimiter: str = ";",
    encoding: str | None = None,
    same_header: bool = False,
    json_lines: bool | None = None,
) -> DataFrame:
    """All scannable files of a dataset as one all-text frame with normalised names.

    Delimited, JSON and Parquet files are one scan each, with the columns of all files; one job finds the headers of
    delimited files. The parts are united by name with NULL for columns a part lacks.
    ``same_header=True`` says that all delimited files share a header and saves that job; ``json_lines=True`` that JSON files hold a
    value per line. JSON text that is no record is a row with nothing but that text, in the column ``BROKEN``, which is
    there only if Spark met such text.
    """
    by_suffix: dict[str, list[str]] = {}
    for path in sorted(files):
        by_suffix.setdefault(file_suffix(path), []).append(path)
    frames: list[DataFrame] = []
    delimited = [p for s in DELIMITED_SUFFIXES for p in by_suffix.get(s, [])]
    if delimited:
        read = read_delimited(spark, delimited, delimiter, encoding, same_header=True) if same_header else read_headed(spark, delimited, delimiter, encoding)
        frames.append(read)
    if documents := by_suffix.get(".json"):
        frames.append(read_json_any(spark, documents, json_lines))
    if parquet := by_suffix.get(".parquet"):
        frames += _parquet_frames(spark, parquet)
    if not frames:
        raise FileNotFoundError("no scannable files")
    return union_by_name([_with_broken(f) for f in frames])


def _with_broken(df: DataFrame) -> DataFrame:
    """All columns as text with normalised names; what Spark could not parse in ``BROKEN``."""
    if CORRUPT not in df.columns:
        return as_text(normalise_columns(df))
    others = [F.col(quoted(c)) for c in df.columns if c != CORRUPT]
    rows = as_text(normalise_columns(df.select(*others, F.col(CORRUPT))))
    return rows.withColumnRenamed(rows.columns[-1], BROKEN)


def _as_list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
