"""Removing repeated passages by two-stage suffix sorting.

Strings of ``LENGTH`` bytes that occur twice must meet in one task without sorting the corpus as a whole. Every such string is
assigned to an anchor: of the ``GRAM``-byte strings in it, the one with the least hash, the leftmost of equal ones. Equal strings
have equal anchors at equal places. Consecutive starts with the same anchor form a run, and only
runs whose anchor occurs twice go on. Runs alike in every byte need no sorting; of those that differ, one copy of each is sorted with the
others of its anchor.

Sorting is in two stages. Only suffixes smaller than their successor are sorted directly. All others follow from one scan over the
buckets of first bytes: the suffix one byte longer than the one at hand goes to the next free place of its bucket. Neighbours in
the order with a common prefix of ``LENGTH`` are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

LENGTH = 400
GRAM = 128
#: Bytes that are searched for anchors, or suffix-sorted, at once.
_SCAN, _SORT = 1 << 19, 1 << 20
#: Different runs that one anchor, or pieces that one part, may have in one sorting task; beyond it they are cut finer (see
#: ``_finer``) in turn into pieces of so many starts. Single starts need no sorting, only counting.
HOT = 2_000
_STEPS = (48, 8, 1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(4)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(2)
def _inverses(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _prefix_hashes(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_grown(len(data)))[: len(data)], out=out[1:])
    return out


def _grown(n: int) -> int:
    """Table sizes come in powers of two, so that few are made."""
    return 1 << max(12, (n + 1).bit_length())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.uint64(2**64 - 1))
    padded[: len(x)] = x
    grid = padded.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def anchored_runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> pd.DataFrame:
    """Runs of starts with one anchor: index of the text, first start ``p``, number of starts ``n``, the anchor's distance ``off`` from
    the first start, its hash ``h``, and a hash ``same`` of the run's bytes. The texts together should be below a few MB."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data) or len(data) < length:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("text", "p", "n", "off", "h", "same")})
    starts = np.cumsum(sizes) - sizes
    sums = _prefix_hashes(data)
    m = len(data) - gram + 1
    hashes = _mixed((sums[gram:] - sums[:m]) * _inverses(_grown(len(data)))[:m])
    places = max(1, len(data).bit_length())
    mask = np.uint64((1 << places) - 1)
    least = _sliding_least((hashes & ~mask) | np.arange(m, dtype=np.uint64), length - gram + 1)
    anchor = (least & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    valid = np.arange(len(anchor)) + length <= (starts + sizes)[owner]
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh & valid)
    # A run ends at the next one or at the last valid start of its text.
    bounds = np.append(np.flatnonzero(fresh), len(anchor))
    ends = bounds[np.searchsorted(bounds, first, side="right")]
    owners = owner[first]
    ends = np.minimum(ends, (starts + sizes)[owners] - length + 1)
    whole = memoryview(data)
    same = [xxhash.xxh3_64_intdigest(whole[a : z + length - 1]) for a, z in zip(first.tolist(), ends.tolist())]
    return pd.DataFrame(
        {
            "text": owners, "p": first - starts[owners], "n": ends - first, "off": anchor[first] - first,
            "h": hashes[anchor[first]].view(np.int64), "same": np.array(same, np.uint64).view(np.int64),
        }
    )


class Prefixes:
    """Common prefixes of suffixes by hashes of substrings, up to ``most`` bytes."""

    def __init__(self, data: np.ndarray, most: int):
        self.data = np.concatenate([data, np.zeros(most + 8, np.uint8)])
        self.sums, self.powers, self.most = _prefix_hashes(self.data), _powers(_grown(len(self.data))), most

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        sa, sb, pa, pb = self.sums[a], self.sums[b], self.powers[a], self.powers[b]
        found = np.zeros(len(a), np.int64)
        step = 1 << (self.most.bit_length() - 1)
        while step:
            tried = found + step
            ok = tried <= self.most
            tried = np.minimum(tried, self.most)
            ok &= (self.sums[a + tried] - sa) * pb == (self.sums[b + tried] - sb) * pa
            found = np.where(ok, tried, found)
            step >>= 1
        return found


def _direct(p: Prefixes, pos: np.ndarray) -> np.ndarray:
    """Sort suffixes by their first ``most`` bytes: by eight bytes, then within equal ones against one of
    them, by where and how they part from it."""
    data, most = p.data, p.most
    key = np.zeros(len(pos), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | data[pos + k].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    pos, key = pos[order], key[order]
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(pos) else np.zeros(0, np.int64)
    open_ = np.arange(len(pos))
    while len(open_):
        g = group[open_]
        starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        sizes = np.diff(np.append(starts, len(g)))
        many = np.repeat(sizes > 1, sizes)
        if not many.any():
            break
        open_ = open_[many]
        sizes = sizes[sizes > 1]
        number = np.repeat(np.arange(len(sizes)), sizes)
        at = pos[open_]
        pivot = np.repeat(at[np.cumsum(sizes) - sizes], sizes)
        far = p.common(at, pivot)
        mine, theirs = data[at + far].astype(np.int64), data[pivot + far].astype(np.int64)
        part = np.where(far >= most, (most + 1) << 8, np.where(mine < theirs, far << 8, (2 * most + 2 - far) << 8) + mine)
        rank = (number << 20) | part
        order = np.argsort(rank, kind="stable")
        pos[open_] = at[order]
        rank = rank[order]
        group[open_] = np.cumsum(np.concatenate([[0], rank[1:] != rank[:-1]]))
        open_ = open_[(rank & ((1 << 20) - 1)) != (most + 1) << 8]
    return pos


def suffix_order(data: np.ndarray, depth: int, prefixes: Prefixes | None = None) -> np.ndarray:
    """Suffixes of ``data`` in the order of their first ``depth`` bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    prefixes = prefixes or Prefixes(data, depth)
    # Where the byte differs from the next one, and the next such place at or after each position.
    differs = np.append(data[:-1] != data[1:], True)
    place = np.where(differs, np.arange(n), n)
    turn = np.minimum.accumulate(place[::-1])[::-1]
    smaller = np.zeros(n, bool)
    inner = turn < n - 1
    smaller[inner] = data[turn[inner]] < data[turn[inner] + 1]
    direct = _direct(prefixes, np.flatnonzero(smaller))
    first = data[direct]
    bounds = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not smaller[n - 1]:
        induced[data[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        wave = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[data[before] == c]
        bucket.append(direct[bounds[c] : bounds[c + 1]])
        full = np.concatenate(bucket)
        out.append(full)
        before = full[full > 0] - 1
        lead = data[before]
        before, lead = before[lead > c], lead[lead > c]
        order = np.argsort(lead, kind="stable")
        before, lead = before[order], lead[order]
        cuts = np.flatnonzero(np.concatenate([[True], lead[1:] != lead[:-1]])) if len(lead) else []
        for a, z in zip(cuts, [*cuts[1:], len(lead)]):
            induced[lead[a]].append(before[a:z])
    return np.concatenate(out)


def repeated_starts(pieces: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, which of its first ``counts`` starts have a string of ``length`` bytes that another start of
    any piece has too."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    offsets = np.cumsum([0, *map(len, pieces)])
    valid = np.zeros(len(data), bool)
    for a, k in zip(offsets, counts):
        valid[a : a + k] = True
    prefixes = Prefixes(data, length)
    order = suffix_order(data, length, prefixes)
    order = order[valid[order]]
    alike = prefixes.common(order[:-1], order[1:]) >= length
    repeated = np.zeros(len(data), bool)
    repeated[order[:-1][alike]] = True
    repeated[order[1:][alike]] = True
    return [repeated[a : a + k] for a, k in zip(offsets, counts)]


def _spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _runs(docs: DataFrame) -> DataFrame:
    """Runs of every text: (tid, p, n, off, h, same)."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tids, texts, held = [], [], 0
            for tid, text in zip(b["tid"], b["data"]):
                # A long text goes in overlapping parts; its runs are then cut at their borders.
                for at in range(0, max(1, len(text) - LENGTH + 1), _SCAN):
                    part = text[at : at + _SCAN + LENGTH - 1]
                    if len(part) < LENGTH:
                        continue
                    if held and held + len(part) > _SCAN:
                        yield _told(tids, texts)
                        tids, texts, held = [], [], 0
                    tids.append((tid, at))
                    texts.append(part)
                    held += len(part)
            if texts:
                yield _told(tids, texts)

    rows = docs.filter(F.octet_length("text") >= LENGTH).select(_tid().alias("tid"), F.col("text").cast("binary").alias("data"))
    return rows.mapInPandas(found, "tid binary, p long, n int, off int, h long, same long")


def _told(tids: list, texts: list[bytes]) -> pd.DataFrame:
    runs = anchored_runs(texts)
    text = runs.pop("text").to_numpy()
    runs["p"] += np.array([at for _, at in tids], np.int64)[text]
    return runs.assign(tid=[tids[i][0] for i in text])[["tid", "p", "n", "off", "h", "same"]]


def _tid() -> Column:
    """Texts are told apart by their MD5."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _texts(docs: DataFrame) -> DataFrame:
    """(tid, packed): every different text once, compressed for the shuffle; copies become one before it."""

    @F.pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pd.Series([press.compress(x) for x in b])

    rows = docs.filter(F.octet_length("text") >= LENGTH).select(_tid().alias("tid"), packed(F.col("text").cast("binary")).alias("packed"))
    return rows.groupBy("tid").agg(F.first("packed").alias("packed"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(tid, s, e): starts s to e - 1 of text ``tid`` have strings of ``LENGTH`` bytes that start elsewhere too."""
    runs = _stored(_runs(docs), "runs")
    anchors = runs.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("same").alias("lo"), F.max("same").alias("hi"))
    anchors = anchors.filter("k > 1").select(F.col("h").alias("h2"), (F.col("lo") != F.col("hi")).alias("mixed"))
    # Stored, so that the join's sides are plain and a frequent anchor's rows can be split among tasks.
    anchors = _stored(anchors, "anchors")
    again = _stored(runs.join(anchors, F.col("h") == F.col("h2")).drop("h2"), "again")
    plain = again.filter("NOT mixed").select("tid", "p", "n")
    mixed = again.filter("mixed")
    forms = mixed.groupBy("h", "same").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("tid", "p", "n", "off")).alias("one"))
    forms = _stored(forms, "forms")
    copies = mixed.join(forms.filter("k > 1").select("h", "same"), ["h", "same"], "left_semi").select("tid", "p", "n")
    sizes = forms.groupBy("h").agg(F.count(F.lit(1)).alias("forms"))
    wanted = _stored(forms.select("h", "one.*", (F.col("k") == 1).alias("alone"), "k").join(sizes, "h"), "wanted")
    pieces, known = _parts(docs, wanted)
    pieces = pieces.join(_texts(docs), "tid").mapInPandas(_bytes, "part long, tid binary, p long, n int, alone boolean, data binary")
    found = pieces.repartition("part").sortWithinPartitions("part").mapInPandas(_sorted, "tid binary, s long, e long")
    whole = plain.union(copies).union(known).select("tid", F.col("p").alias("s"), (F.col("p") + F.col("n")).alias("e"))
    return whole.union(found).distinct()


def _parts(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(part, tid, p, n, alone): what is sorted together, at most HOT pieces a part; and (tid, p, n): pieces known to be repeated.

    The runs of a frequent anchor are cut by ``_finer``. Pieces alike in every byte are counted before they meet: all are repeated, and one
    of each goes on. Parts that still have many different pieces are cut again, in the end to single starts.
    """
    sorting = ["part", "tid", "p", "n", "alone"]
    own = ["h", "tid", "p", "n", "off", "alone"]
    pieces = wanted.filter(F.col("forms") <= HOT).select(F.col("h").alias("part"), *sorting[1:])
    todo = wanted.filter(F.col("forms") > HOT).select(*own)
    known = wanted.filter("false").select("tid", "p", "n")
    for step in _STEPS:
        if todo.isEmpty():
            break
        cut = todo.join(_texts(docs), "tid").mapInPandas(
            _cut(step), "part long, digest binary, h long, tid binary, p long, n int, off int, alone boolean"
        )
        cut = _stored(cut, "cut")
        groups = cut.groupBy("part", "digest").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("tid", "p", "n", "off", "h", "alone")).alias("one"))
        groups = _stored(groups, "groups")
        again = groups.filter("k > 1").select("part", "digest")
        known = known.union(cut.filter("alone").join(again, ["part", "digest"], "left_semi").select("tid", "p", "n"))
        sizes = groups.groupBy("part").agg(F.count(F.lit(1)).alias("forms")).filter("forms > 1")
        rest = groups.select("part", "one.*", "k").withColumn("alone", F.col("alone") & (F.col("k") == 1)).join(sizes, "part")
        if step > 1:
            rest = _stored(rest, "rest")
            pieces = pieces.union(rest.filter(F.col("forms") <= HOT).select(*sorting))
            todo = rest.filter(F.col("forms") > HOT).select(*own)
    return pieces, known


def _cut(step: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pieces of ``step`` starts of each run, with their part and a digest of their bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        columns = ["part", "digest", "h", "tid", "p", "n", "off", "alone"]
        last, text = None, b""
        for b in batches:
            rows = []
            for tid, h, p, n, off, alone, packed in zip(*(b[c] for c in ("tid", "h", "p", "n", "off", "alone", "packed"))):
                if last != tid:
                    last, text = tid, press.decompress(packed)
                for part, a, z in _finer(text, h, p, n, off, step):
                    digest = xxhash.xxh3_128_digest(text[a : z + LENGTH - 1])
                    rows.append((part, digest, h, tid, a, z - a, p + off - a, alone))
                if len(rows) >= 2000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return cut


def _bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of each piece."""
    press = zstandard.ZstdDecompressor()
    columns = ["part", "tid", "p", "n", "alone", "data"]
    last, text = None, b""
    for b in batches:
        rows = []
        for part, tid, p, n, alone, packed in zip(*(b[c] for c in ("part", "tid", "p", "n", "alone", "packed"))):
            if last != tid:
                last, text = tid, press.decompress(packed)
            rows.append((part, tid, p, n, alone, text[p : p + n + LENGTH - 1]))
            if len(rows) >= 2000:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=columns)


def _finer(text: bytes, h: int, p: int, n: int, off: int, most: int) -> list[tuple[int, int, int]]:
    """Cut a run of a frequent anchor by distance to the anchor into pieces of up to ``most`` starts. All strings of a
    piece share at least LENGTH - most + 1 bytes, and only pieces with those bytes alike need to meet."""
    out, anchor = [], p + off
    at = p
    while at < p + n:
        step = (anchor - at) // most  # the same for all starts down to distance step * most
        end = min(p + n, anchor - step * most + 1)
        low, high = anchor - step * most, anchor - step * most - most + 1 + LENGTH
        key = xxhash.xxh3_64(text[low:high])
        key.update(h.to_bytes(8, "little", signed=True) + step.to_bytes(4, "little"))
        out.append((int(np.uint64(key.intdigest()).astype(np.int64)), at, end))
        at = end
    return out


def _sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sort the suffixes of whole parts, some MB at a time."""
    held, size = [], 0
    for b in batches:
        for row in zip(b["part"], b["tid"], b["p"], b["n"], b["alone"], b["data"]):
            if size >= _SORT and row[0] != held[-1][0]:
                yield _repeats(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield _repeats(held)


def _repeats(rows: list) -> pd.DataFrame:
    out = []
    for (_, tid, p, _, alone, _), mask in zip(rows, repeated_starts([r[5] for r in rows], [r[3] for r in rows])):
        if alone:  # runs with copies are known to be repeated
            out += [(tid, p + a, p + z) for a, z in zip(*_spans(mask))]
    return pd.DataFrame(out, columns=["tid", "s", "e"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text): bytes covered by a string of ``LENGTH`` bytes that
    starts anywhere else, in the same or another row, are removed. Strings never cross documents. A null text counts as empty; texts
    shorter than ``LENGTH`` keep all; repeated rows are copies of each other. An empty table gives an empty result.
    """
    spans = repeated_spans(docs).groupBy("tid").agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for tid, spans, packed in zip(b["tid"], b["spans"], b["packed"]):
                text = press.decompress(packed)
                digest, at, runs, gone = hashlib.sha256(), 0, 0, 0
                for s, e in sorted((x["s"], x["e"] + LENGTH - 1) for x in spans):
                    if s > at or not runs:
                        digest.update(text[at:s])
                        runs, gone, at = runs + 1, gone + e - s, e
                    elif e > at:
                        gone, at = gone + e - at, e
                digest.update(text[at:])
                out.append((tid, gone, runs, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["tid", "n_removed", "n_spans", "sha"])

    cut = spans.join(_texts(docs), "tid").mapInPandas(kept, "tid binary, n_removed long, n_spans long, sha string")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", _tid().alias("tid"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("full"))
    return rows.join(cut, "tid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("sha", "full").alias("kept_sha256"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what goes, and how many bytes stay."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))
