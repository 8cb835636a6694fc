"""Hard-negative mining by inner product, with coordinate pruning over length buckets.

Rows are kept in buckets of nearly equal length, cut into blocks. A block holds, for each coordinate, its rows' directions in
sorted order. An anchor that looks for scores of at least s in a block whose longest row has length l needs directions within the angle
arccos(s / (|anchor| l)); for each of its focus coordinates, those of largest share, that leaves a range of values. The rows in all
these ranges are the candidates, and their scores are computed exactly. Blocks that are too short for any candidate are
never sent the anchor. A first round over one block gives each anchor a score that its results reach at
least; the second round, over all other blocks, prunes with it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise

#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 5
#: Share of a block from which the narrowest range isn't worth the others.
NARROW = 0.8
#: Lengths in a bucket differ at most by this factor.
RATIO = 1.1
#: Numbers in a block of rows (so many rows times components), rows at most, and anchors that meet it at once.
CELLS, ROWS, ASKS = 1 << 18, 4_096, 4_096
#: Below and above every score.
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def quantised(embedding: str = "embedding", by: int = 256) -> Column:
    """floor(by x) of each component x, taken as double; null if the vector is null, empty or has null or non-finite components, or
    such of 2^25 or more (sums of their products would leave 64 bits)."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double") * by) >= float(1 << 25)))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * by).cast("long"))
    return F.when(~F.coalesce(bad, F.lit(True)) & (F.size(x) > 0), whole)


def _numbers(rows: pd.Series, limit: int) -> np.ndarray:
    """Vectors of whole numbers as float64 where every sum of products is exact in it, else as int64."""
    x = np.stack(list(rows)).astype(np.int64)
    top = int(np.abs(x).max(initial=0))
    if top * limit * x.shape[1] < 1 << 53:
        return x.astype(np.float64)
    if top * limit * x.shape[1] >= 1 << 62:
        raise ValueError("inner products beyond 64 bits")
    return x


def _ranges(share: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest value of a coordinate of a direction whose cosine with the anchor's is ``least`` or more, from the
    anchor's own share of it."""
    angle, around = np.arccos(np.clip(share, -1, 1)), np.arccos(np.clip(least, -1, 1))
    return np.cos(np.minimum(np.pi, angle + around)) - 1e-9, np.cos(np.maximum(0, angle - around)) + 1e-9


class Block:
    """Rows of a bucket with their sorted coordinate lists."""

    def __init__(self, x: np.ndarray):
        self.x = x
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(norm.max(initial=0))
        self.share = x / np.maximum(norm, 1e-300)[:, None]
        self.order = self.share.argsort(axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.share, self.order, 0)

    def candidates(self, q: np.ndarray, least: float) -> np.ndarray | None:
        """Places of rows that may score ``least`` with ``q``; None for all rows."""
        if least <= 0:
            return None
        length = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        cosine = least / max(length * self.longest, 1e-300)
        if cosine > 1 + 1e-9:
            return np.zeros(0, np.int64)
        share = q / length
        focus = np.argsort(-np.abs(share), kind="stable")[:FOCUS]
        low, high = _ranges(share[focus], cosine)
        ends = [(np.searchsorted(self.sorted[:, f], a), np.searchsorted(self.sorted[:, f], b, "right")) for f, a, b in zip(focus, low, high)]
        narrow = min(range(len(focus)), key=lambda i: ends[i][1] - ends[i][0])
        start, end = ends[narrow]
        if end - start > NARROW * len(self.x):
            return None  # little to win: the whole block is multiplied at once
        found = self.order[start:end, focus[narrow]]
        for i, f in enumerate(focus):
            if i != narrow:
                value = self.share[found, f]
                found = found[(value >= low[i]) & (value <= high[i])]
        return None if 2 * len(found) > len(self.x) else found


def _found(score: np.ndarray, ids: np.ndarray, windows, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each window (name, least, most) the ``k`` highest scores in it, equal ones by id: (name, ids, scores)."""
    out = []
    for name, least, most in windows:
        at = np.flatnonzero((score >= least) & (score <= most))
        if len(at) > k:
            bar = np.partition(score[at], len(at) - k)[len(at) - k]
            at = at[score[at] >= bar]
        at = at[np.lexsort((ids[at], -score[at]))][:k]
        if len(at):
            out.append((name, ids[at], score[at]))
    return out


_HITS = "ask long, window long, vec_id long, score long"


def _compare(k: int, same: bool, limit: int):
    """Task: the best rows of a block for each anchor and window."""

    def compare(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = {"ask": [], "window": [], "vec_id": [], "score": []}
        if len(rows) and len(asks):
            block, q = Block(_numbers(rows["x"], limit)), _numbers(asks["x"], limit)
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            own, own_label = asks["ask"].to_numpy(), asks["label"].to_numpy()
            windows = [[(w["window"], w["least"], w["most"]) for w in ws] for ws in asks["windows"]]

            def told(i: int, score: np.ndarray, at: np.ndarray | slice) -> None:
                fits = (labels[at] == own_label[i]) & (ids[at] != own[i]) if same else labels[at] != own_label[i]
                for name, vec, s in _found(score[fits], ids[at][fits], windows[i], k):
                    found["ask"].append(np.full(len(vec), own[i]))
                    found["window"].append(np.full(len(vec), name))
                    found["vec_id"].append(vec)
                    found["score"].append(s.astype(np.int64))

            whole = []
            for i in range(len(q)):
                at = block.candidates(q[i], min(w[1] for w in windows[i]))
                if at is None:
                    whole.append(i)
                elif len(at):
                    told(i, block.x[at] @ q[i], at)
            for s in range(0, len(whole), 128):
                for i, score in zip(whole[s : s + 128], q[whole[s : s + 128]] @ block.x.T):
                    told(i, score, slice(None))
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in found.items()})

    return compare


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask", "window").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _top(rows: DataFrame, buckets: DataFrame, asks: DataFrame, k: int, same: bool, limit: int) -> DataFrame:
    """(ask, window, vec_id, score, rank): the ``k`` best of ``rows`` (vec_id, label, x, cell, part, lead) in each window of each of ``asks``
    (ask, label, x, length, windows), among rows of the same label or of all others. ``buckets``: cell (and label, if ``same``), number of
    parts and longest row's length of each, and whether the first round takes its first part."""
    n_asks = asks.count()
    groups = max(1, -(-n_asks // ASKS))
    rows = rows.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asks = asks.withColumn("a", F.pmod(F.xxhash64("ask"), F.lit(groups)).cast("int"))

    def round_(first: bool, asks: DataFrame) -> DataFrame:
        # A bucket is too short for an anchor if even its longest row, turned the anchor's way, would score less.
        least = F.array_min(F.transform("windows", lambda w: w["least"])).cast("double")
        reach = F.col("length") * F.col("longest") * (1 + 1e-9) >= least
        if same:
            sent = asks.join(buckets.withColumnRenamed("label", "b_label"), (F.col("label") == F.col("b_label")) & reach).drop("b_label")
        else:
            # Lengths are those of 64-bit numbers, so there are at most some hundred buckets.
            listed = [F.struct(F.lit(b["cell"]).alias("cell"), F.lit(b["parts"]).alias("parts"), F.lit(b["longest"]).alias("longest"),
                               F.lit(b["lead"]).alias("lead")) for b in buckets.collect()]
            sent = asks.withColumn("bucket", F.explode(F.array(*listed))).select("*", "bucket.*").drop("bucket").filter(reach)
        parts = F.sequence(F.lit(0), F.col("parts") - 1)
        parts = F.filter(parts, lambda p: (p == 0) & F.col("lead") if first else (p != 0) | ~F.col("lead"))
        sent = sent.withColumn("part", F.explode(parts))
        grid = ["cell", "part", "a"] + (["label"] if same else [])
        left = rows.filter(F.col("lead") if first else ~F.col("lead")).select("vec_id", "label", "x", "cell", "part", "a").groupBy(*grid)
        right = sent.select(*[F.col(c).alias(c) for c in ("ask", "label", "x", "windows", "cell", "part", "a")]).groupBy(*grid)
        return left.cogroup(right).applyInPandas(_compare(k, same, limit), _HITS)

    early = materialise(_best(round_(True, asks), k).drop("rank"), "early")
    # A window that holds k rows already needs no lower score.
    bars = early.groupBy("ask", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bar")).filter(F.col("n") == k)
    bars = bars.groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct("window", "bar"))).alias("bars"))
    raised = asks.join(bars, "ask", "left").withColumn(
        "windows",
        F.transform("windows", lambda w: F.struct(w["window"].alias("window"), F.greatest(w["least"], F.try_element_at("bars", w["window"])).alias("least"),
                                                  w["most"].alias("most"))),
    ).drop("bars")
    return materialise(_best(early.union(round_(False, raised)), k), "top")


def _bucketed(rows: DataFrame, by: list[str], size: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their bucket's part and whether they are in the first round, and the buckets. The first round takes the first part of the bucket
    with most rows (of each label, if ``by`` names it)."""
    block = max(256, min(ROWS, CELLS // size))
    buckets = rows.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"))
    most = Window.partitionBy(*by).orderBy(F.desc("n"), "cell")
    buckets = buckets.withColumn("lead", F.row_number().over(most) == 1).withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    buckets = materialise(buckets, "buckets")
    dealt = rows.join(buckets.select(*by, "cell", "parts", "lead"), [*by, "cell"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    return dealt.withColumn("lead", F.col("lead") & (F.col("part") == 0)), buckets


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows of ``vectors`` (vec_id, label, x: whole numbers) where ``anchors`` holds.

    Scores are inner products. An anchor's positives are the ``positives`` best other rows of its label; for each, the ``negatives`` best
    rows of other labels come back whose score is from ``low`` to ``high`` percent of the positive's. Higher scores come first, equal ones by
    smaller vec_id. A positive without such rows is absent, so is one with a score below 0 (no score is within).

    Rows with a null id, label, vector or component take no part, nor do those whose length isn't the most frequent one. Of rows that share an id the
    one with the smallest label, then vector, counts. Other columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("x").cast("array<long>").alias("x"))
    whole = ~F.coalesce(F.exists("x", lambda v: v.isNull()), F.lit(True)) & (F.size("x") > 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.*")
    none = F.lit(0.0)
    rows = rows.withColumn("length", F.sqrt(F.aggregate("x", none, lambda a, v: a + v.cast("double") * v.cast("double"))))
    # Rows without a length are in a bucket of their own.
    cell = F.when(F.col("length") > 0, F.floor(F.log("length") / F.log(F.lit(RATIO))).cast("int")).otherwise(-1)
    rows = materialise(rows.withColumn("cell", cell), "rows")
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    size = sizes[0]["size"]
    rows = rows.filter(F.size("x") == size)
    top = F.array_max(F.transform("x", lambda v: F.abs(v)))
    limit = int(rows.agg(F.max(top)).first()[0])

    def window(name, least, most):
        return F.struct(name.cast("long").alias("window"), least.cast("long").alias("least"), most.cast("long").alias("most"))

    asks = rows.filter(anchors).select(F.col("vec_id").alias("ask"), "label", "x", "length")
    any_ = F.array(window(F.lit(0), F.lit(LOWEST), F.lit(HIGHEST)))
    near = _top(*_bucketed(rows, ["label"], size), asks.withColumn("windows", any_), positives, True, limit)
    near = near.select("ask", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # Positives of equal score have one window, named by the score.
    s = F.col("positive_score")
    wanted = near.filter(s >= 0).select("ask", window(s, F.expr(f"({low} * positive_score + 99) div 100"), F.expr(f"({high} * positive_score) div 100")).alias("w"))
    wanted = wanted.filter("w.least <= w.most").groupBy("ask").agg(F.sort_array(F.collect_set("w")).alias("windows"))
    far = _top(*_bucketed(rows, [], size), materialise(asks.join(wanted, "ask"), "asks"), negatives, False, limit)
    far = far.select("ask", F.col("window").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    both = near.join(far, ["ask", "positive_score"])
    return both.select(F.col("ask").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the embeddings whose id is divisible by 50; labels of those divisible by 7 are moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    rows = rows.select("vec_id", moved.alias("label"), quantised().alias("x"))
    return mine(rows, F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
  WHERE r <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
