"""Embedding near-dedup by binary codes of randomly rotated vectors.

A vector o, brought to length 1 and rotated at random, is stored as the signs of its components (the code) and the correction factor
a = <code, o>. For another unit vector q, <code, q> / a is an unbiased estimate of <o, q> whose error has, over rotations, a deviation of
sqrt((1 - a^2) / (a^2 (D - 1)) (1 - <o, q>^2)). Each vector also carries itself as bytes, with the exact length of what that rounding loses.
A pair whose upper confidence bound stays below the threshold is refused; the cosine of any other is computed from the original vectors.

Vectors meet in buckets: a bucket's key is the largest component, with its sign, of two further rotations, and there are
``TABLES`` such tables. A first round over codes finds the vectors that have a possible partner; only these go, as they are, through
a second round. A pair counts in the first table that brings it together. No pairs leave a task: it gives each vector's number of links and a root
of its linked group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .components import connected

THRESHOLD = 0.95
#: Tables, and rotations that make up a key. At a cosine of exactly 0.95 a pair meets in one of them with a probability of 0.999.
TABLES, TURNS = 16, 2
#: Deviations that an estimate may lie below the threshold: a pair is refused wrongly once in some 10^8 times.
DEVIATIONS = 6.0
#: Components of the rotated vectors (at least), and of those that make keys (at most).
LEAST, KEYED = 64, 64
#: Rows of a bucket that meet in one task; larger buckets are cut and their parts paired. Buckets of at most SMALL rows are compared many at a time.
BLOCK, SMALL = 2_000, 32
#: Vectors encoded at once, and numbers gathered at once for exact cosines.
ENCODED, GATHER = 1_000, 1 << 21


@lru_cache(4)
def _rotations(size: int) -> tuple[np.ndarray, np.ndarray]:
    """For vectors of ``size`` components: the rotation of the codes, and those of the keys (one after another), from fixed seeds."""
    wide = max(LEAST, -(-size // 8) * 8)
    rng = np.random.default_rng([size, 13])
    code = np.linalg.qr(rng.standard_normal((wide, wide)))[0][:size]
    keys = [np.linalg.qr(rng.standard_normal((wide, KEYED)))[0][:size] for _ in range(TABLES * TURNS)]
    return code, np.concatenate(keys, axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1. A power of two is taken out first, as squares of very small or large components would be lost."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(x: np.ndarray) -> dict[str, np.ndarray]:
    """Of unit vectors: keys (one per table), code (signs as bits), factor (a), short (rotated vector as bytes), scale and
    lost (length of what the bytes leave out)."""
    turn, turns = _rotations(x.shape[1])
    o = x @ turn
    wide = o.shape[1]
    factor = np.abs(o).sum(axis=1) / np.sqrt(wide)
    scale = np.abs(o).max(axis=1) / 127
    short = np.rint(o / scale[:, None]).astype(np.int8)
    lost = np.linalg.norm(o - short * scale[:, None], axis=1)
    t = (x @ turns).reshape(len(x), TABLES, TURNS, KEYED)
    at = np.abs(t).argmax(axis=3)
    cell = 2 * at + (np.take_along_axis(t, at[..., None], 3)[..., 0] < 0)
    keys = np.zeros((len(x), TABLES), np.int64) + np.arange(TABLES) + TABLES * x.shape[1]
    for j in range(TURNS):
        keys = keys * (2 * KEYED) + cell[:, :, j]
    return {"keys": keys, "code": np.packbits(o >= 0, axis=1), "factor": factor, "short": short, "scale": scale, "lost": lost}


def possible(signs, factor, short, lost, threshold: float = THRESHOLD, outer: bool = False) -> np.ndarray:
    """Whether the upper confidence bound of a pair reaches ``threshold``: ``signs`` (1 and -1) and ``factor`` of one side, ``short`` (rotated vectors
    as the bytes tell them) and ``lost`` of the other; row by row, or all with all."""
    wide = signs.shape[1]
    dot = (signs @ short.T if outer else np.einsum("ij,ij->i", signs, short)) / np.sqrt(wide)
    if outer:
        factor, lost = factor[:, None], lost[None, :]
    # The bound of a pair at the threshold; those above it have narrower ones.
    spread = np.sqrt(np.maximum(0, 1 - factor**2) / (wide - 1) * max(0.0, 1 - threshold**2))
    return dot + DEVIATIONS * spread + lost >= threshold * factor - 1e-6


def _cosines(x: np.ndarray, norm: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out, step = np.empty(len(a)), max(1, GATHER // x.shape[1])
    for s in range(0, len(a), step):
        p, q = a[s : s + step], b[s : s + step]
        out[s : s + step] = (x[p] * x[q]).sum(axis=1) / (norm[p] * norm[q])
    return out


def _whole_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut the stream, which is sorted by tile, so that each tile is in one piece."""
    held = None
    for b in batches:
        b = b if held is None else pd.concat([held, b], ignore_index=True)
        last = b.iloc[-1]
        open_ = ((b["bucket"] == last["bucket"]) & (b["i"] == last["i"]) & (b["j"] == last["j"])).to_numpy()
        cut = int(open_.argmax())
        if cut:
            yield b.iloc[:cut].reset_index(drop=True)
        held = b.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _candidates(b: pd.DataFrame, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (by place) of the same tile that may reach the threshold; rows of a bucket's two different parts are
    compared with each other only."""
    start = np.flatnonzero(np.r_[True, (b[["bucket", "i", "j"]].to_numpy()[1:] != b[["bucket", "i", "j"]].to_numpy()[:-1]).any(axis=1)])
    size = np.diff(np.r_[start, len(b)])
    sizes, side, one = np.repeat(size, size), b["side"].to_numpy(), (b["i"] == b["j"]).to_numpy()
    # Tiles of codes of different lengths may follow each other: each length by itself.
    lengths = b["code"].map(len).to_numpy()
    for length in np.unique(lengths[sizes > 1]):
        own = np.flatnonzero((lengths == length) & (sizes > 1))
        place = np.full(len(b), -1)
        place[own] = np.arange(len(own))
        bits = np.unpackbits(np.frombuffer(b"".join(b["code"].iloc[own]), np.uint8).reshape(len(own), -1), axis=1)
        signs = bits.astype(np.float32) * 2 - 1
        scale = b["scale"].to_numpy(np.float32)[own]
        short = np.frombuffer(b"".join(b["short"].iloc[own]), np.int8).reshape(len(own), -1) * scale[:, None]
        factor, lost = b["factor"].to_numpy()[own], b["lost"].to_numpy()[own]
        tile = np.repeat(np.arange(len(size)), size)[own]
        few = np.flatnonzero(sizes[own] <= SMALL)
        for off in range(1, SMALL):
            p, q = few[:-off], few[off:]
            near = tile[p] == tile[q]
            if not near.any():
                break
            near &= one[own[p]] | (side[own[p]] != side[own[q]])
            p, q = p[near], q[near]
            for s in range(0, len(p), 65_536):
                x, y = p[s : s + 65_536], q[s : s + 65_536]
                ok = possible(signs[x], factor[x], short[y], lost[y], threshold)
                yield own[x[ok]], own[y[ok]]
        for first, n in zip(start[size > SMALL], size[size > SMALL]):
            if lengths[first] != length:
                continue
            rows = place[first : first + n]
            single = one[first]
            left = rows if single else rows[side[own[rows]] == 0]
            right = rows if single else rows[side[own[rows]] == 1]
            for s in range(0, len(left), 256):
                x = left[s : s + 256]
                ok = possible(signs[x], factor[x], short[right], lost[right], threshold, outer=True)
                if single:
                    ok &= x[:, None] < right[None, :]
                p, q = np.nonzero(ok)
                yield own[x[p]], own[right[q]]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least one that the pairs lead to."""
    root = np.arange(n)
    while True:
        new = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def usable(embedding: str = "embedding") -> Column:
    """The vector, with -0.0 as 0.0; null if it is null, empty, zero or has null or non-finite components."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = ~F.coalesce(bad, F.lit(True)) & F.exists(x, lambda v: v != 0)
    return F.when(fine, F.transform(x, lambda v: F.when(v == 0, F.abs(v)).otherwise(v)))


def _tiles(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (node, keys, others) once per table and tile (bucket, i, j) it takes part in, dealt to tasks by tile and sorted. A bucket of
    more than BLOCK rows is cut into parts by hash; each two parts, and each part alone, are a tile."""
    spread = rows.select("*", F.posexplode("keys").alias("at", "bucket"))
    counts = rows.select(F.explode("keys").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = counts.filter(F.col("n") > BLOCK).select(F.col("bucket").alias("large"), F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    spread = spread.join(materialise(large, name), F.col("bucket") == F.col("large"), "left")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    spread = spread.withColumn("part", F.coalesce(part, F.lit(0)))
    others = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)

    def tile(o: Column) -> Column:
        return F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j"), (F.col("part") > o).cast("int").alias("side"))

    spread = spread.select("*", F.inline(F.transform(others, tile))).drop("large", "parts", "part")
    return spread.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """For different vectors (node, size, embedding): (node, links) of those linked to another one, ``size`` of each counted, and
    (a, b) edges that join the linked groups."""
    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lengths = b["embedding"].map(len).to_numpy()
            pieces = [(n, s) for n in np.unique(lengths) for s in range(0, int((lengths == n).sum()), ENCODED)]
            for length, s in pieces:
                own = b[lengths == length].iloc[s : s + ENCODED]
                e = encode(unit(np.stack(list(own["embedding"])).astype(np.float64)))
                yield pd.DataFrame({
                    "node": own["node"].to_numpy(), "keys": list(e["keys"]), "code": [c.tobytes() for c in e["code"]], "factor": e["factor"],
                    "short": [s.tobytes() for s in e["short"]], "scale": e["scale"], "lost": e["lost"],
                })

    columns = "code binary, factor double, short binary, scale double, lost double"
    codes = vectors.select("node", "embedding").mapInPandas(coded, f"node long, keys array<long>, {columns}")
    codes = materialise(codes, "codes")

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _whole_tiles(batches):
            seen = np.zeros(len(b), bool)
            for p, q in _candidates(b, threshold):
                seen[p] = seen[q] = True
            yield pd.DataFrame({"node": np.unique(b["node"].to_numpy()[seen])})

    active = materialise(_tiles(codes, "large").drop("keys").mapInPandas(met, "node long").distinct(), "active")
    chosen = codes.join(active, "node", "left_semi").join(vectors.select("node", "size", "embedding"), "node")
    chosen = materialise(chosen, "chosen")

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _whole_tiles(batches):
            found = []
            keys, at = np.stack(list(b["keys"])), b["at"].to_numpy()
            lengths = b["embedding"].map(len).to_numpy()
            exact = {}
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                x = unit(np.stack(list(b["embedding"].iloc[own])).astype(np.float64))
                place = np.full(len(b), -1)
                place[own] = np.arange(len(own))
                exact[length] = x, np.sqrt((x * x).sum(axis=1)), place
            for p, q in _candidates(b, threshold):
                # Met in an earlier table: counted there.
                first = np.ones(len(p), bool)
                for t in range(TABLES):
                    first &= (at[p] <= t) | (keys[p, t] != keys[q, t])
                p, q = p[first], q[first]
                for length in np.unique(lengths[p]):
                    x, norm, place = exact[length]
                    u, v = (side[lengths[p] == length] for side in (p, q))
                    near = _cosines(x, norm, place[u], place[v]) >= threshold
                    found.append((u[near], v[near]))
            if not found:
                continue
            p, q = (np.concatenate(f) for f in zip(*found))
            size, count = b["size"].to_numpy(), np.zeros(len(b), np.int64)
            np.add.at(count, p, size[q])
            np.add.at(count, q, size[p])
            root, node = _roots(len(b), p, q), b["node"].to_numpy()
            some = np.flatnonzero(count)
            yield pd.DataFrame({"node": node[some], "links": count[some], "root": node[root[some]]})

    partial = materialise(_tiles(chosen, "large").mapInPandas(linked, "node long, links long, root long"), "linked")
    counted = partial.groupBy("node").agg(F.sum("links").alias("links"))
    return counted, partial.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding; other columns are ignored): how many other rows
    have a cosine of at least ``threshold``, the smallest vec_id that links lead to, and whether that is the row's own.

    Equal vectors are linked, are compared with others once and count as often as they occur; rows that share an id are vectors of their own. Vectors
    that are null, empty, zero or hold null or non-finite components, those of another length, and rows without an id link with nothing.
    A row without an id is its own component, with a null component_id, and kept. An empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id").isNotNull(), usable()).alias("embedding"))
    equal = rows.filter("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("size"))
    # Stored with its numbers, so that a retried task can't give others.
    equal = materialise(equal.select(F.monotonically_increasing_id().alias("node"), "first", "size", "embedding"), "vectors")
    counted, edges = links(equal, threshold)
    # Every node of the edges is in ``reach``, roots too.
    reach = connected(edges).join(equal.select("node", "first"), "node")
    least = reach.groupBy("root").agg(F.min("first").alias("component"))
    named = reach.select("node", "root").join(least, "root").select("node", "component")
    told = equal.join(counted, "node", "left").join(named, "node", "left")
    told = told.filter("size > 1 OR links IS NOT NULL").select(
        F.col("embedding").alias("e"), F.xxhash64("embedding").alias("h"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
        F.coalesce("component", "first").alias("c"),
    )
    # Rows without a vector are spread by their ids.
    key = F.when(F.col("embedding").isNull(), F.xxhash64("vec_id")).otherwise(F.xxhash64("embedding"))
    both = rows.withColumn("key", key).join(told, (F.col("key") == F.col("h")) & (F.col("embedding") == F.col("e")), "left")
    component = F.coalesce("c", "vec_id")
    return both.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")
    )


def op13_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whatever their labels."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach AS r JOIN pairs AS p ON r.b = p.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM embeddings LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least ON least.a = vec_id"""
