"""Language identification: blended-spectrum n-gram presence kernel, Nystroem landmarks, and one-versus-rest
kernel ridge regression.

The kernel of two texts is the number of 1- to 3-grams both contain, divided by the geometric mean of how many
each contains. With landmark presence rows G, their norms D and the regression weights B on the Nystroem
features, a text's scores p G^T D^-1/2 Kmm^-1/2 B / |p| are a matrix product over a whole batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Training documents and landmarks per language, chosen by a hash of the id.
TRAIN_DOCUMENTS = 250
LANDMARKS = 40
#: Most training documents of all languages, which share them evenly; more languages than that are an error.
TRAIN_TOTAL = 2_000
#: Columns per n-gram length; n-grams are hashed to them.
_BITS = 13
_WIDTH = 1 << _BITS
DIMENSIONS = 3 * _WIDTH
_CHUNK = 1_000_000
_ROWS = 256
_MULTIPLIER = np.uint32(2654435761)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-cased letter of each character below 65536, 0 for anything else."""
    table = np.zeros(65536, np.uint32)
    for i in range(65536):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Presence row of each text, and whether it has a letter. Anything but letters parts words."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    some = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        tail = np.zeros(1, np.uint32)
        for start in range(0, len(text), _CHUNK):
            codes = np.frombuffer(text[start : start + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
            c = _letters()[np.minimum(codes, 65535)]
            for far in np.unique(codes[codes > 65535]):
                if unicodedata.category(chr(far))[0] == "L":
                    c[codes == far] = far
            some[i] |= bool(c.any())
            c = np.concatenate([tail, c, np.zeros(int(start + _CHUNK >= len(text)), np.uint32)])
            c = c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]  # one gap between words
            tail = c[-2:]
            pair = c[:-1] * np.uint32(0x10001) + c[1:]
            grams = (c, pair, pair[:-1] * np.uint32(0x01000193) + c[2:])
            for n, g in enumerate(grams):
                out[i, n * _WIDTH + ((g * _MULTIPLIER) >> np.uint32(32 - _BITS))] = 1
    return out, some


@dataclass
class Classifier:
    languages: list[str]
    weights: np.ndarray  # DIMENSIONS x languages

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for start in range(0, len(texts), _ROWS):
            part = texts[start : start + _ROWS]
            p, some = presence([t or "" for t in part])
            raw = (p @ self.weights) / np.sqrt(np.maximum(p.sum(1), 1))[:, None]
            best = raw.argmax(1)
            for i, (b, ok) in enumerate(zip(best, some)):
                names.append(self.languages[b] if ok else "und")
                scores[start + i] = min(1.0, max(0.0, float(raw[i, b]))) if ok else 0.0
        return names, scores


def fit(p: np.ndarray, languages: np.ndarray, landmarks: np.ndarray, ridge: float = 1e-3) -> Classifier:
    """``p``: presence rows; ``landmarks``: indices of those rows that serve as landmarks."""
    names = sorted(set(languages))
    norm = np.sqrt(np.maximum(p.sum(1), 1))
    unit = p / norm[:, None]
    k_nm = (unit @ unit[landmarks].T).astype(np.float64)
    values, vectors = np.linalg.eigh(k_nm[landmarks])
    root = (vectors / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    phi = k_nm @ root
    target = (languages[:, None] == np.array(names)[None, :]).astype(np.float64)
    beta = np.linalg.solve(phi.T @ phi + ridge * len(p) * np.eye(len(landmarks)), phi.T @ target)
    return Classifier(names, (unit[landmarks].T.astype(np.float64) @ (root @ beta)).astype(np.float32))


def _remainder(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def train(docs: DataFrame, per_language: int = TRAIN_DOCUMENTS) -> Classifier | None:
    """Learn from documents with a language, a text and an id whose crc32 isn't divisible by 5; at most
    ``per_language`` of each language and ``TRAIN_TOTAL`` of all. Every language is learned; more than ``TRAIN_TOTAL`` of
    them are an error. None if there are none."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (_remainder(F.col("doc_id")) != 0))
    counts = known.groupBy("lang").count().limit(TRAIN_TOTAL + 1).collect()
    if len(counts) > TRAIN_TOTAL:
        raise ValueError(f"documents in more than {TRAIN_TOTAL} languages")
    per_language = min(per_language, max(1, TRAIN_TOTAL // max(1, len(counts))))
    counts = docs.sparkSession.createDataFrame(counts, "lang string, count long")
    # Thin out by hash first, so that what a window sorts is bounded however frequent a language is.
    draw = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    thin = known.select("doc_id", "lang", "text").join(F.broadcast(counts), "lang").withColumn("draw", draw)
    thin = thin.filter(F.col("draw") * F.col("count") < 2 * per_language + 50)
    thin = thin.groupBy("doc_id", "lang", "draw").agg(F.min("text").alias("text"))
    # Only what is learned from goes to the driver.
    thin = thin.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))).filter(F.col("n") <= per_language)

    def rows(batches):
        for whole in batches:
            for start in range(0, len(whole), _ROWS):
                b = whole.iloc[start : start + _ROWS]
                packed = [bytes(r) for r in np.packbits(presence(list(b["text"]))[0] > 0, axis=1)]
                yield b[["lang", "draw", "doc_id"]].assign(p=packed)

    sample = thin.mapInPandas(rows, "lang string, draw double, doc_id long, p binary").toPandas()
    if sample.empty:
        return None
    sample = sample.sort_values(["lang", "draw", "doc_id"]).groupby("lang").head(per_language).reset_index(drop=True)
    p = np.unpackbits(np.stack([np.frombuffer(x, np.uint8) for x in sample["p"]]), axis=1).astype(np.float32)
    each = max(1, min(LANDMARKS, 1000 // sample["lang"].nunique()))
    return fit(p, sample["lang"].to_numpy(), sample.groupby("lang").head(each).index.to_numpy())


def identify(docs: DataFrame, model: Classifier | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (columns of these names are replaced): the language of
    the whole text, ``und`` with score 0 for a null text, one without a letter, or without a model. Equal scores go to the language
    that comes first by code point; repeated rows get the same. An empty table gives an empty result."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names, scores = model.predict(list(b)) if model else (["und"] * len(b), np.zeros(len(b)))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    own = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(F.struct("*").alias("_row"), predicted.asNondeterministic()(F.col(text)).alias("_found"))
    return found.select(*own, "_found.lang_pred", "_found.score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(_remainder(F.col("doc_id")) == 0, F.lit(False))
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
