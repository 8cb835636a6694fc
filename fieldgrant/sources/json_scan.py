"""JSON files of any shape as one record per line: lines, documents over several lines, arrays, any number of each.

A file whose every line is a JSON value is left as it is. Any other is scanned for its structure: whether a line starts within a string, and
how deep, depends on all text before it. Both are running sums, so they are taken in two passes: sums per block of a file (as
Spark splits it), running sums of these over the blocks, and then the cut, in which each task reads its blocks with the state that they start
in. Only what a block's edge parts is shuffled. A record is an outermost object, or an
outermost object in the array that a file begins with, so one array of any size is read by many tasks. Text outside
the records stays as lines of its own, which do not parse and are counted by the reader. A file whose brackets do not close is taken line by line.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import block_columns
from .scratch import materialise, scratch_path, unsorted
from .snapshots import delete_paths, path_exists

#: A string, or what a line holds of it; and this, a bracket, or text between these. Nothing in them backtracks.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"?+'
_TOKENS = re.compile(_STRING + r"|[{}\[\]]|[^\"{}\[\]]++")
#: Ends a line that stops within a string: no JSON parser takes it there, as it would not take the line's end. Begins a line that is
#: more than one value, of which a parser would take the first.
_BROKEN = "\u0001"
#: By byte: whether it tells of structure, by how much it changes the depth, and whether it is more than what may stand between records.
_MARK = np.isin(np.arange(256), list(b'"{}[]\\\n'))
_STEP = (np.isin(np.arange(256), list(b"{[")) * 1 - np.isin(np.arange(256), list(b"}]"))).astype(np.int64)
_TOLD = (~np.isin(np.arange(256), list(b", \t\r\n[]"))).astype(np.int64)


# The tasks' functions go to them with the plan: reading landed files asks of executors only that they have Arrow and NumPy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _key(path: str) -> str:
    """A path as it is compared: without scheme and escapes."""
    return unquote(path.split(":", 1)[-1].replace("///", "/").replace("//", "/"))


@dataclass(frozen=True)
class JsonFiles:
    """Paths whose lines are records, and paths to scan for their structure."""

    lines: list[str]
    others: list[str]


def _text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    rows = spark.read.text(list(paths)).select(*block_columns(), "value")
    return rows.filter(F.trim("value") != "")


def _single(value: Column) -> Column:
    """Whether a text is one JSON value and nothing else. Parsers stop after a value, so it is read as what an array holds, and a
    field: a text that closed one of these too early could not close the other."""
    return F.get_json_object(F.concat(F.lit("["), value, F.lit("]")), "$").isNotNull() & F.get_json_object(
        F.concat(F.lit('{"k":'), value, F.lit("}")), "$"
    ).isNotNull()


def json_files(spark: SparkSession, paths: Sequence[str]) -> JsonFiles:
    """Tell the files below ``paths`` apart, in one job over all of them; one short row per file comes to the driver, which names them to the
    readers. Files without text are left out."""
    # Most lines of indented documents show at their ends that they are no value, and are not parsed for it.
    value = F.trim("value")
    part = F.left(value, F.lit(1)).isin("}", "]", ",", ":") | F.right(value, F.lit(1)).isin("{", "[", ",", ":") | value.rlike(r'^"[^"\\]*+"\s*+:')
    files = _text(spark, paths).groupBy("path").agg(F.count_if(F.when(part, True).otherwise(~_single(F.col("value")))).alias("broken")).collect()
    given = {_key(p): p for p in paths}
    named = sorted((given.get(_key(r["path"]), unquote(r["path"])), r["broken"]) for r in files)
    return JsonFiles([p for p, broken in named if not broken], [p for p, broken in named if broken])


def _numbered(rows: DataFrame) -> DataFrame:
    """The lines with 64 bits for their file, and where its block starts."""
    return rows.select(F.xxhash64("path").alias("file"), "start", "value")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The batches' rows that one block holds: all columns but the last, which they have in common, and the lines' text, each with a line feed."""
    for batch in batches:
        *told, lines = batch.columns
        file, start = (np.asarray(c) for c in told[:2])
        edges = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1), len(lines)]
        for i, j in zip(edges, edges[1:]):
            if i < j:
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), lines.slice(i, j - i)), "\n")
                yield tuple(c[i].as_py() for c in told), np.frombuffer(text[0].as_buffer().to_pybytes() + b"\n", np.uint8)


def _marks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes, brackets and line feeds that no backslash takes away, these characters, and the quotes before each."""
    at = np.flatnonzero(_MARK[text])
    found = text[at]
    if (slashes := found == ord("\\")).any():
        own = at[slashes]
        first = np.maximum.accumulate(np.where(np.diff(own, prepend=-2) != 1, np.arange(len(own)), 0))
        escaped = np.zeros(len(text) + 1, bool)
        escaped[own[(own - own[first]) % 2 == 0] + 1] = True
        kept = ~slashes & ~(escaped[at] & (found != ord("\n")))
        at, found = at[kept], found[kept]
    quotes = found == ord('"')
    return at, found, np.cumsum(quotes) - quotes


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: its quotes, and for a block that starts outside of a string (0) and in one (1) the depth that it adds, the least on
    the way, and its first opening bracket."""
    blocks: dict[tuple, list] = {}
    for key, text in _runs(batches):
        own = blocks.setdefault(key, [0, [0, 0, ""], [0, 0, ""]])
        _, found, quotes = _marks(text)
        for inside in (0, 1):
            outside = (found != ord('"')) & ((quotes + own[0] + inside) % 2 == 0)
            steps = _STEP[found[outside]]
            depth, total = np.cumsum(steps), own[1 + inside]
            if not total[2] and (opening := np.flatnonzero(steps == 1)).size:
                total[2] = chr(found[outside][opening[0]])
            if depth.size:
                total[:2] = total[0] + int(depth[-1]), min(total[1], total[0] + int(depth.min()))
        own[0] += int((found == ord('"')).sum())
    rows = [(*key, n, *a, *b) for key, (n, a, b) in blocks.items()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 9, [pa.int64()] * 5 + [pa.string(), pa.int64(), pa.int64(), pa.string()])], [f"c{i}" for i in range(9)])


def _states(rows: DataFrame) -> DataFrame:
    """What each block starts with: (file, start, inside, depth, level, closed); ``closed`` is of its file."""
    sums = _numbered(rows).mapInArrow(_sums, "file long, start long, quotes long, n0 long, least0 long, first0 string, n1 long, least1 long, first1 string")
    sums = materialise(sums, "blocks")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    told = sums.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    n, least, first = (F.when(F.col("inside") == 1, F.col(f"{c}1")).otherwise(F.col(f"{c}0")).alias(c) for c in ("n", "least", "first"))
    told = told.select("file", "start", "inside", "quotes", n, least, first).withColumn("depth", F.coalesce(F.sum("n").over(before), F.lit(0)))
    closed = (F.sum("quotes").over(whole) % 2 == 0) & (F.sum("n").over(whole) == 0) & (F.min(F.col("depth") + F.col("least")).over(whole) >= 0)
    # A file that begins with an array holds records in arrays.
    begins = F.min_by("first", F.when(F.col("first") != "", F.col("start"))).over(whole)
    return materialise(told.select("file", "start", "inside", "depth", F.when(begins == "[", 1).otherwise(0).cast("long").alias("level"), closed.alias("closed")), "states")


#: Kinds of what the cut gives: records and text that belongs to none; what a block holds of a record that an earlier one
#: begins, and of one that it begins and a later one ends.
_WHOLE, _HEAD, _TAIL = 0, 1, 2
#: How records are compressed until they are read; a file of them is what one task cut.
_CODEC = "lz4"


def _between(text: bytes, inside: bool, ends: Sequence[bool]) -> Iterator[str]:
    """What lies outside of records, cut at brackets and strings, without commas and arrays' brackets. ``inside``: it begins in a string;
    ``ends``: whether its lines end in one."""
    for i, line in enumerate(text.decode("utf-8", "replace").split("\n")):
        tokens = _TOKENS.findall(('"' if inside else "") + line)
        if tokens and inside:
            tokens[0] = tokens[0][1:]
        if i < len(ends):
            inside = bool(ends[i])
            tokens = [*tokens[:-1], (tokens[-1] if tokens else "") + (_BROKEN if inside else " ")]
        yield from (t for t in (token.strip(", \t") for token in tokens) if t not in ("", "[", "]"))


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, kind, value) from the lines of blocks and the states that these start in."""

    def given(key: tuple, kind: int, values: pa.Array) -> pa.RecordBatch:
        n = len(values)
        same = [pa.array(np.full(n, v), pa.int64()) for v in (*key[:2], kind)]
        return pa.RecordBatch.from_arrays([*same, values], ["file", "start", "kind", "value"])

    def rest() -> Iterator[pa.RecordBatch]:
        """What is open where a block ends."""
        if known is not None and (open_ or depth > known[4]):
            # Text in which no record begins is to stay none whatever follows.
            held = b"".join(open_) if open_ else _BROKEN.encode()
            yield given(known, _HEAD if headed else _TAIL, pa.array([held.decode("utf-8", "replace")], pa.string()))

    known, inside, depth, open_, headed = None, 0, 0, [], False
    for key, text in _runs(batches):
        if key != known:
            yield from rest()
            known, (_, _, inside, depth, level) = key, key
            open_, headed = [], depth > level
        at, found, quotes = _marks(text)
        within = (quotes + inside) % 2 == 1
        steps = np.where(within, 0, _STEP[found])
        depths = depth + np.cumsum(steps)
        feeds = found == ord("\n")
        text = text.copy()
        text[at[feeds]] = np.where(within[feeds], ord(_BROKEN), ord(" "))
        ends = at[(steps == -1) & (depths == level)]
        begins = at[(steps == 1) & (depths == level + 1) & (found == ord("{"))]
        done = 0
        if open_ or headed:
            done = int(ends[0]) + 1 if ends.size else len(text)
            open_.append(text[:done].tobytes())
            if ends.size:
                yield given(key, _HEAD if headed else _WHOLE, pa.array([b"".join(open_).decode("utf-8", "replace")], pa.string()))
                open_, headed = [], False
        # A record lies from its opening bracket to the next place where the depth is that of its file's records again.
        after = np.searchsorted(ends, begins)
        stops = ends[after[after < len(ends)]] + 1
        whole = begins[: len(stops)]
        bounds = np.concatenate([[done], np.column_stack([whole, stops]).ravel(), [int(begins[len(stops)]) if len(stops) < len(begins) else len(text)]])
        bounds[-1] = max(bounds[-1], done)
        if len(stops):
            cells = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(text)])
            yield given(key, _WHOLE, cells.take(pa.array(np.arange(1, len(bounds) - 1, 2))))
        told = _TOLD[text]
        told[at[feeds & within]] = 1
        told = np.concatenate([[0], np.cumsum(told)])
        for i in np.flatnonzero(told[bounds[1::2]] > told[bounds[::2]]):
            start, stop = (int(b) for b in bounds[2 * i : 2 * i + 2])
            here = feeds & (at >= start) & (at < stop)
            apart = text[start:stop].copy()
            apart[at[here] - start] = ord("\n")
            values = list(_between(apart.tobytes(), bool(start == 0 and inside), within[here]))
            yield given(key, _WHOLE, pa.array(values, pa.string()))
        if len(stops) < len(begins):
            open_ = [text[int(begins[len(stops)]) :].tobytes()]
        inside = (int(inside) + int((found == ord('"')).sum())) % 2
        depth = int(depths[-1])
    yield from rest()


def _records(spark: SparkSession, paths: Sequence[str]) -> str:
    """A folder of text files, compressed, with a line for each record and each text that belongs to none. Of files whose brackets don't close:
    for each of their lines.

    Records that lie in one block are written there as they are cut, so scratch holds them once; what blocks' edges part is written beside
    them, put together and added."""
    out = scratch_path(spark, "records")
    whole, edges = f"{out}/kind={_WHOLE}", [f"{out}/kind={kind}" for kind in (_HEAD, _TAIL)]
    rows = _text(spark, paths)
    states = _states(rows)
    # One short row per block goes to all tasks, which so read their lines in order.
    closed = _numbered(rows).join(F.broadcast(states.filter("closed").drop("closed")), ["file", "start"])
    cut = closed.select("file", "start", "inside", "depth", "level", "value").mapInArrow(_cut, "file long, start long, kind long, value string")
    told = F.when(F.col("kind") == _WHOLE, F.col("value")).otherwise(F.concat_ws(" ", "file", "start", "value"))
    with unsorted(spark, 3):
        cut.select(told.alias("value"), "kind").write.partitionBy("kind").text(out, compression=_CODEC)
    parts = [spark.read.text(e).select(F.split("value", " ", 3).alias("v"), F.lit(k).alias("kind")) for k, e in zip((_HEAD, _TAIL), edges) if path_exists(spark, e)]
    unclosed = states.filter("NOT closed").select("file").distinct()
    more = []
    if parts:
        order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        parts = reduce(DataFrame.union, parts).select(*[F.col("v")[i].cast("long").alias(c) for i, c in enumerate(("file", "start"))], "kind", F.col("v")[2].alias("value"))
        parts = parts.withColumn("record", F.count_if(F.col("kind") == _TAIL).over(order))
        pieces = F.array_sort(F.collect_list(F.struct("start", "kind", "value")))
        joined = parts.groupBy("file", "record").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "").alias("value"))
        more.append(joined.select("value"))
    if not unclosed.isEmpty():
        line = F.col("value")
        alone = _numbered(rows).join(unclosed, "file", "left_semi")
        more.append(alone.select(F.when(_single(line), line).otherwise(F.concat(F.lit(_BROKEN), line)).alias("value")))
    if more or not path_exists(spark, whole):
        found = reduce(DataFrame.union, more) if more else spark.createDataFrame([], "value string")
        found.write.mode("append").text(whole, compression=_CODEC)
    delete_paths(spark, edges)
    return whole


def as_lines(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths to read as JSON lines in place of ``paths`` (files, or folders of such): every record of every file is a
    line there, and so is, unparsable, any text that belongs to no record."""
    files = json_files(spark, paths)
    return [*files.lines, _records(spark, files.others)] if files.others else files.lines
