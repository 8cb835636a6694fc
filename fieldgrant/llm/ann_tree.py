"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and sent to every task; every vector is filed in a leaf. A query
walks the tree through a priority queue, nearest centre first, to as many leaves as a sample of
queries needed for the recall wanted, and on while these hold too few vectors, and is compared exactly with all
vectors filed there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise

#: Vectors the tree is fitted on, and sampled queries its leaf visits are calibrated with.
SAMPLE = 16_000
QUERIES = 400
BRANCHES = 12
LEAF = 256
#: Recall to reach on the sample.
RECALL = 0.98
#: Vectors, and queries, of a leaf that one task compares; larger leaves are split.
BLOCK = 8_000
#: Parts over which equal queries are spread when they get their results.
SALTS = 16


@dataclass
class Tree:
    """Nodes of a k-means tree over unit vectors; a node without children is a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int] = field(default_factory=list)  # number of the leaf, -1 for others
    visits: int = 1

    def file(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each vector, by going to the nearest child."""
        out = np.zeros(len(unit), np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                continue
            pick = (unit[rows] @ self.centres[kids].T).argmax(1)
            todo += [(kids[k], rows[pick == k]) for k in np.unique(pick)]
        return out

    def leaves(self, q: np.ndarray) -> Iterator[int]:
        """Leaves for one unit vector, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                yield self.leaf[node]
                continue
            for far, kid in zip(-(self.centres[kids] @ q), kids):
                heapq.heappush(queue, (float(far), kid))

    def nearest_leaves(self, q: np.ndarray, sizes: np.ndarray, least: int) -> list[int]:
        """``visits`` leaves, and more until they hold ``least`` vectors; ``sizes``: how many each leaf holds."""
        out, held = [], 0
        for leaf in self.leaves(q):
            if len(out) >= self.visits and held >= least:
                break
            out.append(leaf)
            held += sizes[leaf]
        return out


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        pick = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, pick, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def fit(unit: np.ndarray, seed: int = 0) -> Tree:
    """A tree over unit vectors, and the number of leaves to visit for ``RECALL`` of the 5 nearest."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.zeros((1, unit.shape[1])), [[]], [-1])
    centres, todo, n_leaves = [np.zeros(unit.shape[1])], [(0, np.arange(len(unit)))], 0
    while todo:
        node, rows = todo.pop()
        split = _k_means(unit[rows], BRANCHES, rng) if len(rows) > LEAF else []
        pick = (unit[rows] @ np.asarray(split).T).argmax(1) if len(split) > 1 else np.zeros(len(rows), int)
        if len(np.unique(pick)) < 2:
            tree.leaf[node], n_leaves = n_leaves, n_leaves + 1
            continue
        for k in np.unique(pick):
            centres.append(split[k])
            tree.children.append([])
            tree.leaf.append(-1)
            tree.children[node].append(len(centres) - 1)
            todo.append((len(centres) - 1, rows[pick == k]))
    tree.centres = np.stack(centres)
    # Copies would need no visits: equal vectors are filed as few.
    tree.visits = _calibrated(tree, np.unique(unit, axis=0), n_leaves, rng)
    return tree


def _calibrated(tree: Tree, unit: np.ndarray, n_leaves: int, rng: np.random.Generator) -> int:
    """Widen the visits until the sampled queries find ``RECALL`` of their true neighbours."""
    filed = tree.file(unit)
    chosen = rng.choice(len(unit), min(QUERIES, len(unit)), replace=False)
    needed = []
    for i in chosen:
        score = unit @ unit[i]
        score[i] = -np.inf
        true = np.argpartition(-score, min(5, len(unit) - 1) - 1)[: min(5, len(unit) - 1)] if len(unit) > 1 else []
        turn = {leaf: k + 1 for k, leaf in enumerate(tree.leaves(unit[i]))}
        needed += [turn[filed[j]] for j in true]
    if not needed:
        return n_leaves
    return int(np.quantile(needed, RECALL, method="higher"))


def _unit(rows: pd.Series, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors, each scaled by a power of two (which changes no cosine), and their unit vectors."""
    x = np.stack(list(rows)).astype(np.float64) if len(rows) else np.zeros((0, size))
    # The squares of very small or large components would underflow or overflow.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])
    return x, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as floats or doubles): without null ids, null, empty or zero vectors, null or non-finite
    components. Rows alike count once."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    infinite = [float("inf"), float("-inf")]
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | v.isin(infinite))
    x = x.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(~F.coalesce(bad, F.lit(True)))
    return x.filter(F.exists("embedding", lambda v: v != 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of ``vectors`` found for each of ``queries`` (both vec_id,
    embedding), never the query's own row. Equal scores go to the smaller id. Rows alike in id and vector count once;
    rows that share an id only are rows of their own. Vectors that aren't ``usable`` take no part, nor do those whose
    length differs from the most frequent one. Empty tables give an empty result.

    Equal vectors are compared once: of each, the ``k`` + 1 smallest ids are filed, as no query can need another,
    and equal queries are asked once.
    """
    spark = vectors.sparkSession
    vectors = usable(vectors)
    sizes = vectors.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total = sizes[0]["size"], sizes[0]["count"]
    vectors = vectors.filter(F.size("embedding") == size)
    queries = usable(queries).filter(F.size("embedding") == size).distinct()
    most = max(100, min(SAMPLE, (64 << 20) // (8 * size)))
    draw = F.pmod(F.xxhash64(F.lit("ann"), "vec_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = vectors.withColumn("d", draw).filter(F.col("d") < min(1.0, 1.1 * most / total)).orderBy("d", "vec_id").limit(most)
    sample = sample.toPandas()
    if sample.empty:
        sample = vectors.limit(most).toPandas()
    sent = spark.sparkContext.broadcast(fit(_unit(sample["embedding"], size)[1]))

    def filed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaf=sent.value.file(_unit(b["embedding"], size)[1]))

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaves=[sent.value.nearest_leaves(u, held.value, k + 1) for u in _unit(b["embedding"], size)[1]])

    kind = vectors.schema["embedding"].dataType.simpleString()
    # Spark keeps the first rows of each group before the shuffle, so a frequent vector sends few.
    equal = Window.partitionBy("embedding").orderBy("vec_id")
    first = vectors.distinct().withColumn("n", F.row_number().over(equal)).filter(F.col("n") <= k + 1).drop("n")
    members = materialise(first.mapInPandas(filed, f"vec_id long, embedding {kind}, leaf long"), "filed")
    # One number per leaf; the tree's size bounds them.
    sizes = np.zeros(max(sent.value.leaf) + 1, np.int64)
    for r in members.groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    held = spark.sparkContext.broadcast(sizes)
    asks = queries.groupBy("embedding").agg(F.count(F.lit(1))).select(F.monotonically_increasing_id().alias("ask"), "embedding")
    asks = materialise(asks, "asks")
    asked = materialise(asks.mapInPandas(probes, f"ask long, embedding {kind}, leaves array<long>"), "asked")
    asked = asked.select("ask", "embedding", F.explode("leaves").alias("leaf"))
    # One row per leaf and side; the tree's size bounds them.
    split = members.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("rows"))
    split = split.join(asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("asks")), "leaf")
    split = F.broadcast(split)
    grid = ("leaf", "m", "a")

    def part(df, key, own, other, c_own, c_other):
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(c_own)
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(c_other)
        return df.join(split, "leaf").select(key, "embedding", "leaf", mine, spread)

    left = part(members, "vec_id", "rows", "asks", "m", "a").groupBy(*grid)
    right = part(asked, "ask", "asks", "rows", "a", "m").groupBy(*grid)

    def compare(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asks.empty:
            return pd.DataFrame({"ask": [], "vec_id": [], "score": [], "same": []})
        rows = rows.sort_values("vec_id")
        x, unit = _unit(rows["embedding"], size)
        ids = rows["vec_id"].to_numpy()
        norm = np.sqrt((x * x).sum(axis=1))
        found = []
        q, q_unit = _unit(asks["embedding"], size)
        q_ids, q_norm = asks["ask"].to_numpy(), np.sqrt((q * q).sum(axis=1))
        original, q_original = (np.stack(list(d["embedding"])) for d in (rows, asks))
        least = max(0, len(rows) - k - 1)
        for start in range(0, len(q), 128):
            near = q_unit[start : start + 128] @ unit.T
            for i, scores in enumerate(near, start):
                at = np.flatnonzero(scores >= np.partition(scores, least)[least] - 1e-9)
                # Summed row by row in one order, so that equal vectors get equal scores.
                exact = (x[at] * q[i]).sum(axis=1) / (norm[at] * q_norm[i])
                best = np.lexsort((ids[at], -exact))[: k + 1]
                same = (original[at][best] == q_original[i]).all(axis=1)
                found.append((np.repeat(q_ids[i], len(best)), ids[at][best], exact[best], same))
        return pd.DataFrame(dict(zip(("ask", "vec_id", "score", "same"), map(np.concatenate, zip(*found)))))

    pairs = left.cogroup(right).applyInPandas(compare, "ask long, vec_id long, score double, same boolean")
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    near = pairs.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    near = near.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score", "same"))).alias("near"))
    # Back to all queries; a frequent one is spread over ``SALTS`` parts.
    near = near.join(asks, "ask").select("embedding", "near", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = queries.select(F.col("vec_id").alias("query_id"), "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt"))
    others = F.filter("near", lambda n: ~(n["same"] & (n["vec_id"] == F.col("query_id"))))
    ranked = salted.join(near, ["embedding", "salt"]).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "n"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "n.vec_id", "n.score")


def op9_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.filter("vec_id % 50 = 0"))
