"""Token ids as binary segments with Elias-Fano document boundaries.

A segment is: magic, version, bytes per id, number of documents, number of ids, width and byte lengths
of the boundary structure, the ids, the boundary structure, and a crc32 of all before. Boundary
i is where document i ends. Segments are rows of a Parquet table, since executors reach shared storage only through
Spark's writers; a row's bytes are a complete file of this format.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .elias_fano import EliasFano

MAGIC = b"EFID"
_HEADER = struct.Struct("<4sBBHQQIQQQ")
#: Ids per segment; a longer document makes a segment of its own.
SEGMENT_IDS = 1 << 20
END = 0
#: Words whose ids a worker remembers: the first ones met, so nearly all frequent ones.
CACHE_WORDS = 700_000


def pack(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """A segment; ``ends``: where each document ends in ``ids``."""
    index = EliasFano.of(ends)
    body = _HEADER.pack(
        MAGIC, 1, ids.dtype.itemsize, 0, len(ends), len(ids), index.width, len(index.low), len(index.high), len(index.samples)
    )
    body += ids.astype(ids.dtype.newbyteorder("<")).tobytes()
    body += index.low.tobytes() + index.high.tobytes() + index.samples.astype("<u4").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


@dataclass
class Segment:
    ids: np.ndarray
    ends: EliasFano

    @staticmethod
    def parse(data: bytes) -> Segment:
        magic, version, size, _, docs, ids, width, low, high, samples = _HEADER.unpack_from(data)
        if (magic, version) != (MAGIC, 1) or struct.unpack("<I", data[-4:])[0] != zlib.crc32(data[:-4]):
            raise ValueError("not a whole segment")
        at = _HEADER.size
        values = np.frombuffer(data, f"<u{size}", ids, at)
        at += ids * size
        part = [np.frombuffer(data, np.uint8, n, o) for n, o in ((low, at), (high, at + low))]
        index = EliasFano(docs, width, *part, np.frombuffer(data, "<u4", samples, at + low + high))
        return Segment(values, index)

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i``, by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def _byte_letters() -> list[str]:
    """The printable character that byte-level tokenizers write for each byte: itself where printable, else
    the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class WordEncoder:
    """Encodes whole texts with a byte-level tokenizer of the tokenizers library, remembering words.

    The tokenizer's pattern always parts a text before a single space between two other characters, and
    around a line feed between two others, so a text's ids are those of its words in turn. Texts with
    other runs of spaces are cut only where that holds.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.first: dict[str, bytes] = {}  # at the start of a line
        self.later: dict[str, bytes] = {}  # after a space
        self.feed = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str, space: str) -> bytes:
        if word.isalpha():  # one piece of the pattern: the model alone decides
            spelt = "".join(map(self.letters.__getitem__, (space + word).encode()))
            return np.array([t.id for t in self.model.tokenize(spelt)], self.dtype).tobytes()
        if word[-1] in ".,!?;:" and word[:-1].isalpha():
            return self._known(word[:-1], space) + self._known(word[-1], "")
        return self._whole(space + word)

    def _known(self, word: str, space: str) -> bytes:
        cache = self.later if space else self.first
        found = cache.get(word)
        if found is None:
            found = self._word(word, space) if word != word[-1] or word.isalpha() else self._whole(space + word)
            if len(cache) < CACHE_WORDS:
                cache[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian integers of ``dtype``."""
        out = []
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(self.feed)
            words = line.split(" ")
            parts = list(map(self.later.get, words))
            parts[0] = self.first.get(words[0])
            if None in parts:
                for i, p in enumerate(parts):
                    if p is None:
                        w = words[i]
                        if not w or w[0].isspace() or w[-1].isspace():
                            # Runs of spaces, or a line that starts or ends with one, or is empty.
                            return self._with_runs(text)
                        parts[i] = self._known(w, " " if i else "")
            out += parts
        return b"".join(out)

    def _with_runs(self, text: str) -> bytes:
        """Cuts only at single spaces and line feeds with no white space beside them."""
        out, start = [], 0
        n = len(text)
        for i in range(1, n - 1):
            c = text[i]
            if c in " \n" and not text[i - 1].isspace() and not text[i + 1].isspace():
                out.append(self._piece(text[start:i]))
                if c == "\n":
                    out.append(self.feed)
                    start = i + 1
                else:
                    start = i
        out.append(self._piece(text[start:]) if start < n else b"")
        return b"".join(out)

    def _piece(self, piece: str) -> bytes:
        space = " " if piece[:1] == " " and len(piece) > 1 else ""
        word = piece[len(space) :]
        if not word or word[0].isspace() or word[-1].isspace():
            return self._whole(piece)
        return self._known(word, space)


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    """The worker's encoder, kept from batch to batch."""
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(definition)
    return _ENCODERS[key]


SEGMENTS = "part int, segment int, n_ids long, doc_ids array<long>, data binary"


def write(docs: DataFrame, definition: str, path: str, end: int = END) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order (null first; equal ids by a hash of the text) and write
    segments to ``path``. A null text counts as empty; ``end`` follows every document. Repeated rows are documents of their own, side by
    side; a text is encoded whole and may be larger than a segment should be. An empty table gives a table without segments."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    rows = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    # Ids go to Python as text: pandas would turn numbers with a null among them into floating point.
    ordered = ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text")

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(sent.value)
        stop = np.array([end], encoder.dtype).tobytes()
        part, number = TaskContext.get().partitionId(), 0
        size = encoder.dtype.itemsize
        held, ends, names, total = [], [], [], 0

        def made():
            ids = np.frombuffer(b"".join(held), encoder.dtype)
            row = {"part": part, "segment": number, "n_ids": len(ids), "doc_ids": names, "data": pack(ids, np.array(ends))}
            return pd.DataFrame([row])

        for b in batches:
            for i, text in zip(b["doc_id"], b["text"]):
                data = encoder.encode(text or "") + stop
                if held and total + len(data) // size > SEGMENT_IDS:
                    yield made()
                    number += 1
                    held, ends, names, total = [], [], [], 0
                held.append(data)
                total += len(data) // size
                ends.append(total)
                names.append(None if i is None else int(i))
        if held:
            yield made()

    ordered.mapInPandas(segments, SEGMENTS).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the segments alone; no rows if there are none. Repeated documents
    give repeated rows, each with a start of its own."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    sizes = files.select("part", "segment", "n_ids")
    before = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # One row per writing task, so one window over them is small.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    offsets = sizes.withColumn("inner", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(parts, "part")
    offsets = offsets.select("part", "segment", (F.col("base") + F.col("inner")).alias("offset"))

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, segment, names, data in zip(b["part"], b["segment"], b["doc_ids"], b["data"]):
                s = Segment.parse(data)
                ends = s.ends.values().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = s.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts, ends)]
                yield pd.DataFrame(
                    {
                        "part": part, "segment": segment, "doc_id": list(names),
                        "inside": starts, "n_tokens": ends - starts, "ids_crc32": crc,
                    }
                )

    ids = F.transform("doc_ids", lambda i: i.cast("string")).alias("doc_ids")
    found = files.select("part", "segment", ids, "data").mapInPandas(
        documents, "part int, segment int, doc_id string, inside long, n_tokens long, ids_crc32 long"
    )
    return found.join(offsets, ["part", "segment"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    path = scratch_path(spark, "tokens")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), definition, path)
    return read(spark, path)
