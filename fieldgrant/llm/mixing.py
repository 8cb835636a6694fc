"""Mixing sources to target weights.

Every source's documents fall into a fixed number of blocks by a hash, and the blocks have a pseudo-random
order. A pass over a source takes whole blocks in that order and, of the last block, the documents
up to a threshold. A multivariate-hypergeometric splitting tree deals each source's exact number of drawn blocks to
output shards; shards take disjoint runs of the block order and are shuffled within. A document is in the mix as
often as a shard draws its block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .text import word_count

#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (3.0, 1.0, 2.0)
#: The mix's size as a multiple of all sizes, and the most a source or document may be repeated.
SHARE = 1.5
MOST = 2.0
#: Blocks per source; a block is the most that one task orders by document.
BLOCKS = 1024
#: Most sources; a row for each is held by the driver and sent to every task.
MAX_SOURCES = 50_000
SHARDS = 16
#: Words of a shard that one task shuffles; larger shards are dealt to several tasks first.
PART_WORDS = 50_000_000
#: Words of the runs that a part is cut into, in its order; a task of this or a later step takes one, so that no core waits for one large part.
SLICE_WORDS = 2_000_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Split ``share`` of all sizes by weight; a source stops at ``most`` times its size, and what
    it can't take is shared by weight among the rest."""
    result = [0.0] * len(sizes)
    rest, left = list(range(len(sizes))), share * sum(sizes)
    while rest:
        weight = sum(weights[i] for i in rest)
        full = [i for i in rest if left * weights[i] / weight >= most * sizes[i]]
        if not full:
            for i in rest:
                result[i] = left * weights[i] / weight
            break
        for i in full:
            result[i] = most * sizes[i]
        left -= sum(result[i] for i in full)
        rest = [i for i in rest if i not in set(full)]
    return result


def split_quotas(quotas: np.ndarray, shards: int, seed: int = 0) -> np.ndarray:
    """Deal ``quotas`` blocks of each source to shards: (shards, sources). Each node of a binary tree over
    the shards draws its left half's blocks without replacement from all blocks it holds."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def node(lo: int, hi: int, held: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = held
            return
        mid = (lo + hi) // 2
        take = int(round(held.sum() * (mid - lo) / (hi - lo)))
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(held, take, method="marginals") if held.sum() else held * 0
        node(lo, mid, left)
        node(mid, hi, held - left)

    node(0, shards, np.asarray(quotas, np.int64))
    return out


@dataclass
class Plan:
    """``sources``: one row per source, small enough to send out; ``shards``: how many, each of ``parts`` parts of ``slices`` runs."""

    sources: DataFrame
    shards: int
    parts: int
    slices: int


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """source, _size, _h (a row's hash), _pos (its block's place in the source's order) and ``more``."""
    salt = F.coalesce(F.xxhash64(F.lit("blocks"), "source"), F.lit(0))
    step, shift = 2 * F.pmod(salt, F.lit(BLOCKS // 2)) + 1, F.pmod(F.shiftright(salt, 20), F.lit(BLOCKS))
    block = F.pmod(F.shiftrightunsigned("_h", 40), F.lit(BLOCKS))
    hashed = F.xxhash64(F.lit("mix"), "doc_id", "text").alias("_h")
    rows = docs.select("source", word_count(F.col("text")).alias("_size"), hashed, *more)
    return rows.withColumn("_pos", F.pmod(block * step + shift, F.lit(BLOCKS)).cast("int"))


def plan_mix(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> Plan:
    """What to take of each source. ``docs`` has source, _size, _h and _pos."""
    spark = docs.sparkSession
    blocks = docs.groupBy("source", "_pos").agg(F.sum("_size").alias("words"))
    blocks = materialise(blocks, "blocks")
    sizes = {r[0]: r[1] for r in blocks.groupBy("source").agg(F.sum("words")).limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = targets([sizes[s] for s in names], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))])
    rows, quotas = [], []
    for s, t in zip(names, wanted):
        passes = int(t // sizes[s]) if sizes[s] else 0
        rows.append((s, sizes[s], float(t), passes, float(t - passes * sizes[s])))
    wishes = spark.createDataFrame(rows, "source string, source_size long, target double, passes int, need double")
    same = blocks["source"].eqNullSafe(wishes["source"])
    summed = Window.partitionBy("source").orderBy("_pos")
    # A window holds the blocks of one source, at most BLOCKS rows.
    cut = (
        blocks.join(F.broadcast(wishes), same).select(wishes["source"], "_pos", "words", "need")
        .filter("need > 0")  # else whole passes are all there is, for documents without words too
        .withColumn("sum", F.sum("words").over(summed))
        .filter(F.col("sum") > F.col("need"))
        .groupBy("source").agg(F.min(F.struct("_pos", "sum", "words", "need")).alias("c"))
        .select("source", F.col("c._pos").alias("cut"), (F.col("c.need") - F.col("c.sum") + F.col("c.words")).alias("rest"))
    )
    cut = materialise(cut, "cut")
    inside = docs.select("source", "_pos", "_h", "_size")
    inside = inside.join(F.broadcast(cut.withColumnRenamed("source", "s")), inside["source"].eqNullSafe(F.col("s")) & (F.col("_pos") == F.col("cut")))
    # One block of each source; rows alike share their hash and are taken or left together.
    by_hash = inside.groupBy("source", "rest", "_h").agg(F.sum("_size").alias("w"))
    by_hash = by_hash.withColumn("upto", F.sum("w").over(Window.partitionBy("source").orderBy("_h")))
    near = F.col("upto") - F.col("w") / 2.0 <= F.col("rest")  # nearer with it than without
    last = by_hash.filter(near).groupBy("source").agg(F.max("_h").alias("last")).collect()
    last = {r["source"]: r["last"] for r in last}
    cuts = {r["source"]: r["cut"] for r in cut.collect()}
    for s, _, _, passes, _ in rows:
        quotas.append(passes * BLOCKS + (cuts[s] + (s in last) if s in cuts else 0))
    dealt = split_quotas(np.array(quotas, np.int64), shards, seed).cumsum(axis=0) if rows else np.zeros((shards, 0), int)
    full = [
        (*r[:4], cuts.get(r[0], 0), last.get(r[0]), [int(x) for x in dealt[:-1, i]])
        for i, r in enumerate(rows)
    ]
    schema = "_source string, source_size long, target double, passes int, cut int, last long, ends array<long>"
    parts = 1 + int(sum(wanted) / (shards * PART_WORDS))
    return Plan(spark.createDataFrame(full, schema), shards, parts, 1 + int(sum(wanted) / (shards * parts * SLICE_WORDS)))


def with_draws(docs: DataFrame, plan: Plan) -> DataFrame:
    """Adds source_size, target and _draws: (index, shard) of each draw of the document's block. A source's drawn blocks are numbered
    through its passes; a shard draws those numbers from its left neighbour's end to its own. Of the last one, only
    documents up to the threshold are drawn."""
    joined = docs.join(F.broadcast(plan.sources), F.col("source").eqNullSafe(F.col("_source")), "left")
    whole = F.col("passes") * BLOCKS + F.col("cut")
    turns = F.transform(F.sequence(F.lit(0), F.col("passes")), lambda t: t * BLOCKS + F.col("_pos"))
    drawn = F.filter(turns, lambda i: (i < whole) | ((i == whole) & (F.col("_h") <= F.col("last"))))
    shard = lambda i: F.size(F.filter("ends", lambda e: e <= i))
    return joined.withColumn("_draws", F.transform(drawn, lambda i: F.struct(i.alias("index"), shard(i).alias("shard"))))


def assignments(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, shards) of every document; ``docs`` has doc_id, text and source. ``shards`` tells the
    number of each shard that draws it, ``taken`` is its size for each of these.

    A null text has size 0; a null source is a source of its own, the last. Rows alike in doc_id and text
    are taken together. Reruns agree. An empty table gives an empty result.
    """
    keyed = materialise(_keyed(docs, F.col("doc_id")), "sizes")
    found = with_draws(keyed, plan_mix(keyed, shards, seed))
    taken = (F.col("_size") * F.size("_draws")).alias("taken")
    return found.select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", taken, F.col("_draws.shard").alias("shards"))


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """The mix itself: ``docs`` with every document as often as shards draw it, dealt to shards and
    shuffled within each; parts of a large shard are random, too. Columns are those of ``docs``."""
    plan = plan_mix(materialise(_keyed(docs), "sizes"), shards, seed)
    drawn = with_draws(_keyed(docs, F.struct("*").alias("_row")), plan)
    drawn = drawn.select("_row", "_h", F.explode("_draws").alias("_draw"))
    order = F.xxhash64(F.lit(seed), "_h", F.floor(F.col("_draw.index") / BLOCKS) + 1)
    drawn = drawn.withColumn("_order", order).withColumn("_part", F.pmod("_order", F.lit(plan.parts))).withColumn("_shard", F.col("_draw.shard"))
    # Where in the range of all hashes the order lies, in as many steps as there are slices: a part's slices follow each other.
    upper = F.shiftrightunsigned(F.col("_order").bitwiseXOR(F.lit(-(1 << 63))), 33)
    number = (F.col("_shard") * plan.parts + F.col("_part")) * plan.slices + F.shiftright(upper * plan.slices, 31)
    dealt = drawn.repartitionById(plan.shards * plan.parts * plan.slices, number.cast("int"))
    return dealt.sortWithinPartitions("_shard", "_part", "_order").select("_row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assignments(docs).select("doc_id", "size", "source_size", "target", "taken", "shards")
