"""Ranked lexical search by dense blocked multiplication.

Documents are cut into terms once and stored as the terms that some item asks for, with their frequencies. Item weights of one
vocabulary tile times the impacts of one document tile are a dense float64 product; all factors are whole numbers and a
tile's partial sums stay below 2^53, so every product is exact, and tiles are added as 64-bit integers. A task
keeps each item's best documents over its tiles, equal scores included until the ids decide; a window over these ends the search.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .text import bounded

#: Terms of items and their places that one pass over the documents may send to the tasks; more items take further passes.
MAX_POSTINGS = 4_000_000
#: Items, vocabulary terms and documents of a tile. Weights are below 2^16 and impacts below 2^20, so a sum over
#: fewer than 2^17 terms stays below 2^53.
ITEMS, TERMS, DOCS = 256, 2_048, 512
#: Bytes of text cut into terms at once.
TEXT_BYTES = 8 << 20

_LETTERS = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
#: Bytes that are in no term become spaces; A-Z become lower case.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c in _LETTERS else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order: runs of ASCII letters and digits and of all other characters beyond ASCII."""
    return text.translate(_TABLE).split()


@dataclass
class Items:
    """Items of one pass: the vocabulary, and each item's distinct terms as places in it."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    places: list[np.ndarray]


def item_passes(items: DataFrame) -> Iterator[Items]:
    """The items, in as many passes as ``MAX_POSTINGS`` needs; one item's terms are never parted. They come to the
    driver one after another."""
    ids, vocabulary, places, held = [], {}, [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        found = sorted(set(terms((r["text"] or "").encode())))
        if not found:
            continue
        if held and held + len(found) > MAX_POSTINGS:
            yield Items(ids, vocabulary, places)
            ids, vocabulary, places, held = [], {}, [], 0
        ids.append(r["item_id"])
        places.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in found], np.int64))
        held += len(found)
    if ids:
        yield Items(ids, vocabulary, places)


def weights(document_counts: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) per term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in document_counts.tolist()], np.int64)


def length_factor(n: int, documents: int, all_terms: int) -> int:
    """A document's m, in whole numbers of any size."""
    return 100 - 50 + (50 * n * documents) // all_terms


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m), for equally long arrays."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def tile_scores(places: list[np.ndarray], weight: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """Scores (items x docs, int64) of one item tile and one document tile, whose entries are (term, doc, impact)."""
    out = np.zeros((len(places), docs), np.int64)
    row = np.repeat(np.arange(len(places)), [len(p) for p in places])
    wanted = np.concatenate(places)
    used = np.intersect1d(wanted, term)  # the compact vocabulary: terms on both sides
    for start in range(0, len(used), TERMS):
        tile = used[start : start + TERMS]

        def place(x):
            at = np.minimum(np.searchsorted(tile, x), len(tile) - 1)
            return at, tile[at] == x

        w, m = np.zeros((len(places), len(tile))), np.zeros((len(tile), docs))
        at, held = place(wanted)
        w[row[held], at[held]] = weight[wanted[held]]
        at, held = place(term)
        m[at[held], doc[held]] = impact[held]
        out += (w @ m).astype(np.int64)
    return out


def _best(score: np.ndarray, number: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores above 0, equal ones by ascending number."""
    at = np.flatnonzero(score > 0)
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= least]
    return at[np.lexsort((number[at], -score[at]))][:k]


def _entries(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, places, tfs): terms of each document with repeats, and the vocabulary's terms in it."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for whole in batches:
            for batch in bounded([whole], "text", TEXT_BYTES):
                n, places, tfs = [], [], []
                for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                    found = terms(text or b"")
                    n.append(len(found))
                    held = Counter(p for p in map(known.get, found) if p is not None)
                    places.append(list(held))
                    tfs.append(list(held.values()))
                columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "places", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(rows.mapInArrow(cut, "doc_id long, n long, places array<int>, tfs array<long>"), "terms")


def _one_pass(items: Items, entries: DataFrame, k: int) -> DataFrame:
    spark = entries.sparkSession
    total = entries.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    documents, all_terms = int(total["documents"]), int(total["terms"])
    df = np.zeros(len(items.vocabulary), np.int64)
    # One row per term of the vocabulary, which the pass bounds.
    counts = entries.select(F.explode("places").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("df")).toPandas()
    df[counts["place"].to_numpy(np.int64)] = counts["df"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast((items.places, weights(df, documents)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, weight = sent.value
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in places]
        for b in batches:
            for start in range(0, len(b), DOCS):
                part = b.iloc[start : start + DOCS]
                held = part["places"].map(len).to_numpy()
                if not held.sum():
                    continue
                doc = np.repeat(np.arange(len(part)), held)
                term = np.concatenate(list(part["places"])).astype(np.int64)
                tf = np.concatenate(list(part["tfs"])).astype(np.int64)
                m = np.array([length_factor(n, documents, all_terms) for n in part["n"].tolist()], np.int64)
                impact = impacts(tf, m[doc])
                # Ids as text, so that large ones beside nulls stay exact; null comes last.
                none = part["doc_id"].isna().to_numpy()
                ids = np.array([0 if x is None else int(x) for x in part["doc_id"]], np.int64)
                for first in range(0, len(places), ITEMS):
                    scores = tile_scores(places[first : first + ITEMS], weight, term, doc, impact, len(part))
                    for i, row in enumerate(scores, first):
                        s, d, x = kept[i]
                        floor = s[-1] if len(s) == k else 1
                        new = np.flatnonzero(row >= floor)
                        if len(new):
                            s, d, x = (np.concatenate(p) for p in ((s, row[new]), (d, ids[new]), (x, none[new])))
                            at = _best(s, np.lexsort((d, x)).argsort(), k)
                            kept[i] = s[at], d[at], x[at]
        found = [(i, s, d, x) for i, (s, d, x) in enumerate(kept) if len(s)]
        if found:
            item = np.concatenate([np.full(len(s), i) for i, s, _, _ in found])
            s, d, x = (np.concatenate([f[j] for f in found]) for j in (1, 2, 3))
            yield pd.DataFrame({"item": item, "doc": [None if gone else str(v) for v, gone in zip(d.tolist(), x)], "score": s})

    rows = entries.filter(F.size("places") > 0).withColumn("doc_id", F.col("doc_id").cast("string"))
    found = rows.mapInPandas(score, "item int, doc string, score long").withColumn("doc_id", F.col("doc").cast("long"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    named = spark.createDataFrame([(i, item) for i, item in enumerate(items.ids)], "item int, item_id long")
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): for each of ``items`` (item_id, text) its ``k`` highest-scoring ``docs`` (doc_id, text) with a score above
    0, all if fewer; equal scores by ascending doc_id, null last.

    All rows take part: repeated documents rank side by side, repeated items give repeated results. Null or empty texts
    have no terms; items without a term that a document has are absent, and so is everything if either table is empty. Texts
    are cut whole, however long. Other columns are ignored.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    chosen = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for one in item_passes(chosen):
        out = out.union(_one_pass(one, _entries(docs, one.vocabulary), k))
    return out


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


_SQL_TERMS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
OP12_SQL = f"""
WITH d AS (SELECT doc_id, unnest({_SQL_TERMS}) AS term FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
i AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, docs),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // terms) AS m FROM n, c),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 50"""
