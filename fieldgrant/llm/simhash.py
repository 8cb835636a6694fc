"""SimHash near-duplicates: a hierarchical index in Gray order.

Fingerprints are dealt five times, each time under another fifth of their bits: two that differ in at most
four bits share one fifth. Within each share they are sorted by Gray rank, which brings those together that
agree in their leading bits. Runs of the order are nodes of a tree; a node holds the bits on which all below it agree
and that no node above it holds. A search adds up differences from the top and drops a whole node as soon
as they exceed the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .components import connected
from .text import UPPER

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Children per node, fingerprints per chunk, and queries that walk the tree together.
FAN, CHUNK, QUERIES = 8, 2048, 256
#: First bit of each fifth, and how many bits it has.
PARTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
_BLOCK = 1 << 16
_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Majority of the bits of the XXH64 of all word shingles, repeats included; 0 without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, _BLOCK):
        hi = min(n, lo + _BLOCK)
        until = ends[min(size, len(words)) - 1 :][lo:hi].tolist()
        hashes = np.array([digest(joined[a:z], SEED) for a, z in zip(starts[lo:hi].tolist(), until)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > n).astype(np.uint64)).sum(dtype=np.uint64))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def _turned(x: np.ndarray, first: int) -> np.ndarray:
    """The bits from ``first`` on (counted from the top) moved to the front."""
    return (x << np.uint64(first)) | (x >> np.uint64(64 - first)) if first else x


class GrayIndex:
    """The tree over fingerprints that are sorted by Gray rank."""

    def __init__(self, codes: np.ndarray):
        every = np.uint64(2**64 - 1)
        self.levels = [(codes, np.full(len(codes), every))]
        while len(self.levels[-1][0]) > 1:
            bits, same = self.levels[-1]
            starts = np.arange(0, len(bits), FAN)
            high = np.bitwise_or.reduceat(bits & same, starts)
            low = np.bitwise_or.reduceat(~bits & same, starts)
            agreed = np.bitwise_and.reduceat(same, starts) & ~(high & low)
            self.levels.append((high & agreed, agreed))
        # What a node holds itself: the bits agreed below it, without those its parent holds.
        self.own = [same for _, same in self.levels]
        for k in range(len(self.levels) - 1):
            above = self.levels[k + 1][1][np.arange(len(self.own[k])) // FAN]
            self.own[k] = self.own[k] & ~above

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) for all pairs that differ in at most ``most`` bits."""
        top = len(self.levels) - 1
        q = np.repeat(np.arange(len(queries)), len(self.levels[top][0]))
        node = np.tile(np.arange(len(self.levels[top][0])), len(queries))
        far = np.zeros(len(q), np.int64)
        for k in range(top, -1, -1):
            bits = self.levels[k][0]
            far = far + np.bitwise_count((queries[q] ^ bits[node]) & self.own[k][node])
            keep = far <= most
            q, node, far = q[keep], node[keep], far[keep]
            if k:
                below = len(self.levels[k - 1][0])
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                q, far = np.repeat(q, FAN), np.repeat(far, FAN)
                real = node < below
                q, node, far = q[real], node[real], far[real]
        return q, node


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of each pair in ``label`` (the smallest member of each group)."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def links(left: np.ndarray, right: np.ndarray | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever pairs within ``most`` bits connect: a forest, fewer than there are codes. ``right`` None: pairs
    within ``left``."""
    codes = left if right is None else np.concatenate([left, right])
    label = np.arange(len(codes))
    index, shift = (GrayIndex(left), 0) if right is None else (GrayIndex(right), len(left))
    for lo in range(0, len(left), QUERIES):
        q, m = index.search(left[lo : lo + QUERIES], most)
        merge(label, q + lo, m + shift)
    moved = np.flatnonzero(label != np.arange(len(codes)))
    return codes[moved], codes[label[moved]]


def _chunks(parts: DataFrame) -> DataFrame:
    """Runs of at most CHUNK fingerprints that share a fifth, in Gray order, with the bits they agree on."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        held = pd.DataFrame()
        for b in batches:
            held = pd.concat([held, b], ignore_index=True)
            made, held = _cut(held, False)
            for row in made:
                row["chunk"] = (part << 32) + number
                number += 1
            if made:
                yield pd.DataFrame(made)
        made, _ = _cut(held, True)
        for row in made:
            row["chunk"] = (part << 32) + number
            number += 1
        if made:
            yield pd.DataFrame(made)

    ordered = parts.repartitionByRange("part", "rank").sortWithinPartitions("part", "rank")
    return ordered.mapInPandas(cut, "part int, share int, codes array<long>, bits long, same long, chunk long")


def _cut(rows: pd.DataFrame, all_of_it: bool) -> tuple[list[dict], pd.DataFrame]:
    made = []
    if not len(rows):
        return made, rows
    part, share = rows["part"].to_numpy(), rows["share"].to_numpy()
    codes = rows["code"].to_numpy().astype(np.int64)
    edges = np.flatnonzero((part[1:] != part[:-1]) | (share[1:] != share[:-1])) + 1
    starts = [0, *edges.tolist()]
    ends = [*edges.tolist(), len(rows)]
    rest = len(rows)
    for k, (a, z) in enumerate(zip(starts, ends)):
        last = k == len(starts) - 1
        at = a
        while at < z:
            if last and not all_of_it and z - at < CHUNK:
                rest = at
                break
            run = codes[at : min(z, at + CHUNK)].view(np.uint64)
            high, low = np.bitwise_or.reduce(run), np.bitwise_or.reduce(~run)
            same = ~(high & low)
            made.append(
                {
                    "part": part[a], "share": share[a], "codes": run.view(np.int64),
                    "bits": int((high & same).astype(np.int64)), "same": int(same.astype(np.int64)),
                }
            )
            at += CHUNK
    return made, rows.iloc[rest:]


def linked(codes: DataFrame, most: int = DISTANCE) -> DataFrame:
    """(a, b): links among distinct fingerprints (column ``code``) that connect the same groups as all pairs
    within ``most`` bits, which must be fewer than there are parts."""
    if most >= len(PARTS):
        raise ValueError(f"at most {len(PARTS) - 1} bits")

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b["code"].to_numpy().astype(np.int64).view(np.uint64)
            for k, (first, bits) in enumerate(PARTS):
                rank = gray_rank(_turned(x, first))
                share = (_turned(x, first) >> np.uint64(64 - bits)).astype(np.int32)
                signed = (rank ^ np.uint64(1 << 63)).view(np.int64)
                yield pd.DataFrame({"part": np.int32(k), "share": share, "rank": signed, "code": x.view(np.int64)})

    chunks = materialise(_chunks(codes.mapInPandas(dealt, "part int, share int, rank long, code long")), "chunks")
    x, y = chunks.alias("x"), chunks.alias("y")
    differ = F.bit_count(
        F.col("x.bits").bitwiseXOR(F.col("y.bits")).bitwiseAND(F.col("x.same")).bitwiseAND(F.col("y.same"))
    )
    near = (F.col("x.chunk") <= F.col("y.chunk")) & (differ <= most)
    same_share = (F.col("x.part") == F.col("y.part")) & (F.col("x.share") == F.col("y.share"))
    pairs = x.join(y, same_share & near).select(
        F.col("x.codes").alias("left"),
        F.when(F.col("x.chunk") != F.col("y.chunk"), F.col("y.codes")).alias("right"),
    )

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out_a, out_b = [], []
            for left, right in zip(b["left"], b["right"]):
                if right is None and len(left) < 2:
                    continue
                as_code = lambda v: np.asarray(v, np.int64).view(np.uint64)
                p, q = links(as_code(left), None if right is None else as_code(right), most)
                out_a.append(p)
                out_b.append(q)
            if out_a:
                yield pd.DataFrame({"a": np.concatenate(out_a).view(np.int64), "b": np.concatenate(out_b).view(np.int64)})

    return pairs.mapInPandas(found, "a long, b long")


def with_fingerprint(docs: DataFrame, size: int = SHINGLE, text: str = "text") -> DataFrame:
    """``docs`` with ``code`` (long; a column of that name is replaced): the fingerprint of the whole text, however long; 0 for a null text or
    one without words. Rows are neither dropped nor merged; a bit set in just half the shingles is 0."""

    @F.pandas_udf("long")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(np.array([fingerprint(t, size) for t in b], np.uint64).view(np.int64))

    return docs.withColumn("code", code.asNondeterministic()(F.col(text)))


def groups(codes: DataFrame, most: int = DISTANCE) -> DataFrame:
    """(code, root, component_id) for every distinct fingerprint of ``codes`` (code, doc_id, anything else):
    the group's representative fingerprint and its smallest doc_id (null if all are null)."""
    distinct = materialise(codes.groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    grouped = connected(linked(distinct.select("code"), most)).withColumnRenamed("node", "code")
    rooted = distinct.join(grouped, "code", "left").withColumn("root", F.coalesce("root", "code"))
    rooted = materialise(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.select("code", "root").join(least, "root")


def hex_code(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text). Rows without words have
    fingerprint 0 and are linked like any other; repeated rows are in one group; a group of null ids only
    has a null component_id. An empty table gives an empty result."""
    codes = materialise(with_fingerprint(docs.select("doc_id", "text"), size).drop("text"), "fingerprints")
    found = codes.join(groups(codes, most), "code")
    return found.select("doc_id", hex_code(F.col("code")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, most: int = DISTANCE) -> DataFrame:
    """One row of each group: that with the smallest doc_id (a null one only if there is no other), of rows with
    equal ids that with the smallest text hash, then the smallest in all columns. Columns are those of ``docs``."""
    text = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), text.alias("text"))
    codes = with_fingerprint(docs.select("doc_id", "text", key.alias("key")), size).drop("text")
    codes = materialise(codes, "fingerprints")
    first = codes.groupBy("code").agg(F.min("key").alias("key"))
    roots = groups(codes.select("code", "doc_id"), most).select("code", "root")
    chosen = first.join(roots, "code").groupBy("root").agg(F.min("key").alias("key")).select("key")
    # Rows alike become one before they are shuffled.
    rows = docs.select(F.struct("*").alias("row"), key.alias("key")).groupBy("key").agg(F.min("row").alias("row"))
    return rows.join(chosen, "key", "left_semi").select("row.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
