"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is exactly one token that its encoding ends with. It is the one that
covers the prefix's tail and, next to the last token of what comes before, leaves no merge across the border.
These last tokens are all that is stored: the encoding is read backwards from any prefix, bytes can be appended,
and after an edit only the prefixes from there on until the old ones recur are worked out again.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pieces whose ids a worker remembers (the first ones met, so nearly all frequent ones), as many beginnings of pieces, and pairs of tokens
#: whose border it has judged.
CACHE_PIECES = 600_000
CACHE_PAIRS = 600_000

#: The pattern for which white space parts pieces as ``pieces`` uses; others are matched over the whole text.
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Marks that this pattern parts from the letters before them, where a word ends with one of them.
_MARKS = frozenset('.,;:!?)"')


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 and id."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class PrefixBpe:
    """Encodes pieces (matches of the pattern) and decodes ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.reached = {}  # tokens that merging their own bytes gives
        for token, i in ranks.items():
            if len(token) == 1:
                self.reached[token] = i
                continue
            halves = self._halves(token, i)
            if halves:
                self.parts[i] = halves
                self.reached[token] = i
        self.judged: dict[tuple[int, int], bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.heads: dict[bytes, int] = {}  # last tokens of beginnings of pieces

    def _halves(self, token: bytes, limit: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``, found by merging its bytes by rank."""
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best, at = limit, -1
            for k in range(len(parts) - 1):
                rank = self.ranks.get(parts[k] + parts[k + 1], limit)
                if rank < best:
                    best, at = rank, k
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """Tokens that stand at one edge of ``token`` while it is made, and the rank of the merge that ends each."""
        found = self.edges[side].get(token)
        if found is None:
            found, until = [(self.bytes[token], float("inf"))], token
            while until in self.parts:
                part = self.parts[until][side]
                found.append((self.bytes[part], until))
                until = part
            self.edges[side][token] = found
        return found

    def stable(self, left: int, right: int) -> bool:
        """No merge crosses the border of two adjacent tokens: each that could comes too late, for one of
        its two tokens is gone by then. Equal ranks go from left to right."""
        known = True
        before, rank_of = self._edge(right, 0), self.ranks.get
        for x, x_until in self._edge(left, 1):
            for y, y_until in before:
                rank = rank_of(x + y)
                if rank is not None and rank < x_until and rank <= y_until:
                    known = False
        if len(self.judged) >= CACHE_PAIRS:
            self.judged.clear()
        self.judged[left, right] = known
        return known

    def last_of(self, data: bytes, last: list[int], end: int) -> int:
        """The last token of the prefix of length ``end``, from those of all shorter ones."""
        token_of, judged = self.reached.get, self.judged.get
        for begin in range(max(0, end - self.longest), end):
            token = token_of(data[begin:end])
            if token is not None:
                if not begin:
                    return token
                before = last[begin - 1]
                known = judged((before, token))
                if known is None:
                    known = self.stable(before, token)
                if known:
                    return token
        raise ValueError("a byte has no token")

    def extend(self, data: bytes, last: list[int], start: int) -> None:
        """Fill ``last`` (token of each prefix) for the prefixes of ``data`` longer than ``start``. A prefix has the same last token in all
        pieces that begin with it, so those of short ones are remembered."""
        heads, last_of, known = self.heads, self.last_of, min(len(data), self.longest)
        for end in range(start + 1, known + 1):
            head = data[:end]
            token = heads.get(head)
            if token is None:
                token = last_of(data, last, end)
                if len(heads) < CACHE_PIECES:
                    heads[head] = token
            last.append(token)
        for end in range(max(start, known) + 1, len(data) + 1):
            last.append(last_of(data, last, end))

    def read(self, last: list[int], end: int) -> list[int]:
        """Encoding of the prefix of length ``end``."""
        out = []
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes[out[-1]])
        return out[::-1]

    def piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(data, last, 0)
        return self.read(last, len(data))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Editable:
    """A piece of bytes kept encoded while it is appended to and edited."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self.bpe.extend(self.data, self.last, start)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` in place of bytes ``start`` to ``stop``; later prefixes keep their tokens once those of as many
        prefixes as the longest token has bytes are the old ones again."""
        old = self.last[stop:]
        self.data = self.data[:start] + new + self.data[stop:]
        del self.last[start:]
        border, same = start + len(new), 0
        for end in range(start + 1, len(self.data) + 1):
            token = self.bpe.last_of(self.data, self.last, end)
            self.last.append(token)
            if end > border:
                same = same + 1 if token == old[end - border - 1] else 0
                if same >= self.bpe.longest:
                    self.last += old[end - border :]
                    return

    def ids(self) -> list[int]:
        whole = self.bpe.ranks.get(self.data)
        return [whole] if whole is not None else self.bpe.read(self.last, len(self.data))


class TextEncoder:
    """Encodes whole texts, each match of the pattern separately, remembering pieces.

    With ``SPACED_PATTERN`` a text is first cut before single spaces and around line feeds that have no
    white space beside them, where the pattern always parts it.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = PrefixBpe(ranks)
        self.find = regex.compile(pattern).findall
        self.spaced = pattern == SPACED_PATTERN
        self.names = {i: str(i) for i in self.bpe.bytes}
        # Ids as bytes, four each: Python's garbage collector would go through millions of tuples again and again.
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.feed = self._pieces("\n")

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.find(text)))

    def _piece(self, piece: str) -> bytes:
        spaced = piece[0] == " " and len(piece) > 1
        cache, key = (self.later, piece[1:]) if spaced else (self.first, piece)
        found = cache.get(key)
        if found is None:
            ids = self.bpe.piece(piece.encode())
            found = struct.pack(f"={len(ids)}i", *ids)
            if len(cache) < CACHE_PIECES:
                cache[key] = found
        return found

    def _word(self, word: str, space: str) -> bytes:
        if word.isalpha():
            return self._piece(space + word)
        if word[-1] in _MARKS and word[:-1].isalpha():
            found = self._piece(space + word[:-1]) + self._piece(word[-1])
        else:
            found = self._pieces(space + word)
        cache = self.later if space else self.first
        if len(word) < 64 and len(cache) < CACHE_PIECES:
            cache[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self._packed(text), np.int32)

    def _packed(self, text: str) -> bytes:
        if not self.spaced:
            return self._pieces(text)
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
                            return self._pieces(text)
                        parts[i] = self._word(w, " " if i else "")
            out += parts
        return b"".join(out)


_ENCODERS: dict[int, TextEncoder] = {}


def text_encoder(ranks: bytes, pattern: str) -> TextEncoder:
    """The worker's encoder, kept from batch to batch."""
    key = hash((ranks, pattern))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(read_ranks(ranks), pattern)
    return _ENCODERS[key]


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int; a column of that name is replaced). A null text is encoded as
    empty: no ids. Rows are neither dropped nor merged, repeated ones get the same ids; an empty table gives an empty result. A text is
    encoded whole, by one task, however long; there are no ties, as a text has one encoding."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = text_encoder(sent.value, pattern)
        for b in batches:
            yield pd.Series([encoder.ids(t or "") for t in b])

    return docs.withColumn("ids", ids.asNondeterministic()(F.col(text)))


def decode(rows: DataFrame, ranks: bytes, pattern: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` (binary; a column of that name is replaced): the bytes that the ids stand for; null ids give null. Rows are
    neither dropped nor merged; an empty table gives an empty result."""
    sent = rows.sparkSession.sparkContext.broadcast(ranks)
    del pattern  # decoding needs the tokens alone

    @F.pandas_udf("binary")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = {i: t for t, i in read_ranks(sent.value).items()}.__getitem__
        for b in batches:
            yield pd.Series([None if x is None else b"".join(map(token, np.asarray(x).tolist())) for x in b])

    return rows.withColumn("decoded", back(F.col(ids)))


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded): encodes every text and decodes its ids, in one pass and a few hundred documents at a time,
    so that a worker holds little. Nulls as for ``encode``."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def both(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(sent.value, pattern)
        for b in batches:
            for start in range(0, len(b), 200):
                part = b.iloc[start : start + 200]
                ids = [encoder.ids(t or "") for t in part["text"]]
                decoded = [encoder.bpe.decode(x.tolist()) for x in ids]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "ids": ids, "decoded": decoded})

    # As text: pandas would turn a column of numbers with a null into floating point.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = rows.mapInPandas(both, "doc_id string, ids array<int>, decoded binary")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes every text, then decodes its ids. Made in one
    pass, so that ids needn't leave the worker. A null text counts as empty, repeated rows give repeated results, and an empty
    table none; texts are taken whole, other columns are ignored."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(sent.value, pattern)
        name = encoder.names.__getitem__
        for b in batches:
            rows = []
            for t in b:
                ids = encoder.encode(t or "")
                listed = hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest()
                rows.append((len(ids), listed, hashlib.sha256(encoder.bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = docs.select("doc_id", "text").withColumn("_d", digest.asNondeterministic()(F.col("text")))
    return found.select("doc_id", "_d.*")


def public_ranks() -> tuple[bytes, str]:
    """Ranks and pattern of the registered query."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), *public_ranks())
