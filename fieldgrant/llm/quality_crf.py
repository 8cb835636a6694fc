"""Quality rules: plain counts, then Viterbi decoding of a linear-chain conditional random field over
a document's lines. A document stays if enough of its words are in lines marked as content.

Only documents are labelled. The model is fitted with the lines' labels unknown: a good document's content is at least the share that
keeps it, a bad one's at most that, and lines that the corpus repeats in different places are boilerplate.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .text import WORD

#: Labelled documents per class, and lines of each, that the model is fitted on.
TRAIN_DOCUMENTS = 1500
TRAIN_LINES = 60
#: Least share of a document's words in content lines.
CONTENT_SHARE = 0.5
MIN_WORDS = 50
#: Different pairs of neighbours from which a line counts as boilerplate in training; fits of single lines, after which they are labelled anew.
CONTEXTS, ROUNDS = 3, 3
#: Constants that are tried for the finished model.
CONSTANTS = tuple(np.arange(-12, 13) / 4)
#: What pushes a document's lines towards its bound, in turn; what a known line weighs.
BIASES, _SURE = (0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 1e6), 1e3
#: Characters handled at once.
_CHUNK = 2_000_000

_SPACE, _ALPHA, _UPPER, _DIGIT, _SYMBOL, _OTHER = 1, 2, 4, 8, 16, 32
_SYMBOLS = "#*$%&|<>"
_FINDER = re.compile(WORD)
FEATURES = 16


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class flags of the characters below 65536; the last entry serves all others."""
    table = np.zeros(65537, np.uint8)
    for i in range(65536):
        c = chr(i)
        kind = unicodedata.category(c)
        if i == 32 or 9 <= i <= 13:
            table[i] = _SPACE
        elif kind[0] == "L":
            table[i] = _ALPHA | (_UPPER if kind == "Lu" else 0)
        elif kind[0] == "N":
            table[i] = _DIGIT
        elif kind[0] in "PS":
            table[i] = _OTHER
    for c in _SYMBOLS:
        table[ord(c)] |= _SYMBOL
    table[65536] = _ALPHA
    return table


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, words per line, characters in words and symbols per line.

    Lines without a word have all features 0, so they carry no evidence.
    """
    codes = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    flags = _classes()[np.minimum(codes, 65536)]
    starts = np.concatenate([[0], np.flatnonzero(codes == 10)[:-1] + 1])
    ends = np.flatnonzero(codes == 10)

    def count(mask):
        return np.add.reduceat(mask.astype(np.int32), starts).astype(np.float64)

    inked = (flags & _SPACE) == 0
    before = np.concatenate([[False], inked[:-1]])
    words, chars = count(inked & ~before), count(inked)
    alpha, upper = count((flags & _ALPHA) > 0), count((flags & _UPPER) > 0)
    digit, symbol = count((flags & _DIGIT) > 0), count((flags & _SYMBOL) > 0)
    other, bang = count((flags & _OTHER) > 0), count(codes == 33)
    last = codes[np.maximum(ends - 1, 0)]
    n = np.maximum(chars, 1)
    x = np.stack(
        [
            np.ones(len(n)),
            upper / np.maximum(alpha, 1),
            upper > 0.6 * np.maximum(alpha, 1),
            symbol / n,
            symbol > 0.02 * n,
            digit / n,
            digit > 0.2 * n,
            other / n,
            other > 0.1 * n,
            bang / n,
            np.log1p(words),
            words < 4,
            words > 20,
            np.minimum(n / np.maximum(words, 1), 30) / 10,
            np.isin(last, [ord(c) for c in ".!?:;\"'”»"]),
            alpha < 0.6 * n,
        ],
        axis=1,
    ).astype(np.float64)
    x[words == 0] = 0
    return x, words, chars, symbol


@dataclass
class Crf:
    """Scores of label 1 (boilerplate) over label 0 (content): features, transitions and first label."""

    weights: np.ndarray
    between: np.ndarray
    first: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def emissions(self, x: np.ndarray) -> np.ndarray:
        seen = x[:, :1]  # 1 unless the line has no word
        return ((x - self.mean) / self.scale * seen) @ self.weights


@dataclass
class _Lines:
    """Documents' lines side by side: features x (line, document, feature), which are there (live), and their labels y."""

    x: np.ndarray
    live: np.ndarray
    y: np.ndarray


def likelihood(flat: np.ndarray, lines: _Lines) -> tuple[float, np.ndarray]:
    """Log likelihood of the labels under ``flat`` (weights, transitions, first label), and its gradient by forward-backward marginals."""
    x, live, y = lines.x, lines.live, lines.y
    longest, n = live.shape
    w, between, first = flat[:FEATURES], flat[FEATURES : FEATURES + 4].reshape(2, 2), flat[-2:]
    e = np.stack([np.zeros((longest, n)), x @ w], axis=2)
    told = np.take_along_axis(e, y[:, :, None], 2)[:, :, 0]
    alpha = np.empty((longest, n, 2))
    alpha[0] = first + e[0]
    score = first[y[0]] + told[0]
    for t in range(1, longest):
        now = np.logaddexp(alpha[t - 1][:, :1] + between[0], alpha[t - 1][:, 1:] + between[1]) + e[t]
        alpha[t] = np.where(live[t][:, None], now, alpha[t - 1])
        score = score + np.where(live[t], between[y[t - 1], y[t]] + told[t], 0)
    z = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
    beta = np.zeros((n, 2))
    g_w, g_b, g_f = np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2)
    for t in range(longest - 1, -1, -1):
        mark = live[t]
        here = np.exp(alpha[t] + beta - z[:, None]) * mark[:, None]
        g_w += x[t].T @ ((y[t] - here[:, 1] / np.maximum(here.sum(1), 1e-12)) * mark)
        if t:
            ahead = beta + e[t]
            pair = np.exp(alpha[t - 1][:, :, None] + between + ahead[:, None, :] - z[:, None, None]) * mark[:, None, None]
            np.add.at(g_b, (y[t - 1][mark], y[t][mark]), 1)
            g_b -= pair.sum(0)
            back = np.logaddexp(between[:, 0] + ahead[:, :1], between[:, 1] + ahead[:, 1:])
            beta = np.where(mark[:, None], back, beta)
        else:
            g_f += np.bincount(y[0], minlength=2) - np.exp(alpha[0] + beta - z[:, None]).sum(0)
    return float((score - z).sum()), np.concatenate([g_w, g_b.ravel(), g_f])


def fit(sequences: list[np.ndarray], labels: list[np.ndarray], steps: int = 250, rate: float = 0.05, ridge: float = 1e-3) -> Crf:
    """Maximum likelihood of the lines' ``labels`` (one array for each document) by gradient ascent."""
    longest, n = max(len(s) for s in sequences), len(sequences)
    lines = _Lines(np.zeros((longest, n, FEATURES)), np.zeros((longest, n), bool), np.zeros((longest, n), np.int64))
    for i, (s, y) in enumerate(zip(sequences, labels)):
        lines.x[: len(s), i], lines.live[: len(s), i], lines.y[: len(s), i] = s, True, y
    rows = lines.x[lines.live]
    seen = rows[:, 0] > 0
    mean, scale = (rows[seen].mean(0), rows[seen].std(0) + 1e-6) if seen.any() else (np.zeros(FEATURES), np.ones(FEATURES))
    mean[0], scale[0] = 0, 1
    lines.x = (lines.x - mean) / scale * lines.x[:, :, :1]
    flat = np.zeros(FEATURES + 6)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        g = likelihood(flat, lines)[1] / lines.live.sum() - ridge * flat
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        flat = flat + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(flat[:FEATURES], flat[FEATURES : FEATURES + 4].reshape(2, 2), flat[-2:], mean, scale)


def fit_shares(sequences: list[np.ndarray], words: list[np.ndarray], good: np.ndarray, known: list[np.ndarray], share: float = CONTENT_SHARE) -> Crf:
    """A model of lines whose own labels aren't told. ``good`` documents have at least ``share`` of their words in content lines, others at most
    that; lines that are ``known`` are boilerplate. Labels start as the documents' own; a model of single lines is fitted to them, and they are
    decoded anew within these bounds, in turn; then the chain is fitted. In the end a constant is set by the documents' labels."""
    y = [np.where(k, 1, 0 if g else 1) for k, g in zip(known, good)]
    # Lines by themselves at first: as documents begin with one label for all lines, transitions would hold them to it.
    alone = [s[i : i + 1] for s in sequences for i in range(len(s))]
    for _ in range(ROUNDS):
        model = fit(alone, [np.array([v]) for v in np.concatenate(y)])
        y = bounded_labels(model, sequences, words, good, known, share)
    model = fit(sequences, y)
    # The constant that keeps most good documents and fewest others, of equal ones the nearest to the one found.
    lengths = np.array([len(s) for s in sequences])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    x, inked = np.concatenate(sequences), np.concatenate(words)
    total = np.maximum(np.add.reduceat(inked, starts), 1)

    def wrong(constant: float) -> int:
        found = viterbi(model, model.emissions(x) + constant * x[:, 0], lengths)
        return int(((np.add.reduceat(inked * (found == 0), starts) / total >= share) != good).sum())

    model.weights[0] += min(CONSTANTS, key=lambda c: (wrong(c), abs(c)))
    return model


def bounded_labels(model: Crf, sequences: list[np.ndarray], words: list[np.ndarray], good: np.ndarray, known: list[np.ndarray], share: float) -> list[np.ndarray]:
    """The best labels of each document whose content is within its bound: all its lines are pushed by the least of
    some biases that brings it there."""
    lengths = np.array([len(s) for s in sequences])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    told = np.concatenate([model.emissions(s) for s in sequences]) + _SURE * np.concatenate(known)
    inked = np.concatenate(words)
    total = np.maximum(np.add.reduceat(inked, starts), 1e-9)
    push = np.where(good, -1.0, 1.0)  # towards content, or away from it
    bias = np.zeros(len(sequences))
    labels = viterbi(model, told, lengths)
    for step in BIASES:
        part = np.add.reduceat(inked * (labels == 0), starts) / total
        out = np.where(good, part < share, part > share)
        if not out.any():
            break
        bias = np.where(out, push * step, bias)
        labels = viterbi(model, told + np.repeat(bias, lengths), lengths)
    return np.split(labels.astype(np.int64), starts[1:])


def viterbi(model: Crf, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best label of every line; ``emissions`` holds the documents' lines one after another. All
    documents advance together, line by line; equal scores go to content."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = starts[order], lengths[order]
    score = np.zeros((len(sizes), 2))
    back = np.zeros((len(emissions), 2), np.uint8)
    for t in range(int(sizes[0]) if len(sizes) else 0):
        k = int(np.searchsorted(-sizes, -t, side="left"))  # documents with more than t lines
        at = starts[:k] + t
        if t == 0:
            score[:k] = model.first
        else:
            from0, from1 = score[:k, :1] + model.between[0], score[:k, 1:] + model.between[1]
            back[at] = from1 > from0
            score[:k] = np.maximum(from0, from1)
        score[:k, 1] += emissions[at]
    label = (score[:, 1] > score[:, 0]).astype(np.uint8)
    labels = np.zeros(len(emissions), np.uint8)
    for t in range(int(sizes[0]) - 1 if len(sizes) else -1, -1, -1):
        k = int(np.searchsorted(-sizes, -t, side="left"))
        at = starts[:k] + t
        labels[at] = label[:k]
        label[:k] = back[at, label[:k]]
    return labels


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, total = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(covered, i)
            covered = i + 3
    return total


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    lines = [x for x in lines if _FINDER.search(x)]
    return len(lines) - len(set(lines))


def judge(texts: list[str | None], model: Crf | None, share: float = CONTENT_SHARE) -> pd.DataFrame:
    """Counts and verdict of each text; a null counts as empty."""
    parts = []
    start = 0
    while start < len(texts):
        stop, held = start, 0
        while stop < len(texts) and (stop == start or held < _CHUNK):
            held += len(texts[stop] or "")
            stop += 1
        parts.append(_judge([t or "" for t in texts[start:stop]], model, share))
        start = stop
    return pd.concat(parts, ignore_index=True) if parts else _judge([], model, share)


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "content_share double, kept boolean"
)


def _judge(texts: list[str], model: Crf | None, share: float) -> pd.DataFrame:
    if not texts:
        return pd.DataFrame({c.split()[0]: [] for c in COLUMNS.split(", ")})
    x, words, chars, symbols = line_features(texts)
    lengths = np.array([t.count("\n") + 1 for t in texts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])

    def per_text(values):
        return np.add.reduceat(values, starts)

    n_words = per_text(words).astype(np.int64)
    repeats = np.array([repeated_words(_FINDER.findall(t)) for t in texts], np.int64)
    failed = (n_words < MIN_WORDS) | (100 * repeats > 50 * n_words)
    content = words
    if model is not None:
        content = words * (viterbi(model, model.emissions(x), lengths) == 0)
    part = per_text(content) / np.maximum(n_words, 1)
    return pd.DataFrame(
        {
            "n_words": n_words,
            "word_chars": per_text(chars).astype(np.int64),
            "n_symbols": per_text(symbols).astype(np.int64),
            "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
            "n_repeat_words": repeats,
            "base_failed": failed,
            "content_share": part,
            "kept": ~failed & (part >= share),
        }
    )


def shared_lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h) of the lines of ``wanted`` (h: xxhash64 of the trimmed line) that stand between ``CONTEXTS`` or more different pairs of lines, in all of
    ``docs``. Copies of a document don't count: there a line has the same neighbours."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.trim(x))
    around = F.transform("lines", lambda x, i: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.get("lines", i - 1), F.get("lines", i + 1)).alias("c"), (x != "").alias("some")))
    rows = docs.select(lines.alias("lines")).select(F.inline(around)).filter("some")
    # At most 2 * TRAIN_DOCUMENTS * TRAIN_LINES numbers are sent out.
    met = rows.join(F.broadcast(wanted), "h").select("h", "c").distinct()
    return met.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= CONTEXTS).select("h")


def train(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCUMENTS) -> Crf | None:
    """Fit on at most ``per_class`` labelled documents of either quality, chosen by a hash of the id,
    with at most ``TRAIN_LINES`` lines each. A document's label bounds the share of its content; which lines are content is found in fitting, from
    lines that the whole corpus repeats in different places. None if only one quality, or none, is labelled."""
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64(F.lit("crf"), "doc_id"), "doc_id"]
    chosen = [known.filter(F.col("quality") == q).orderBy(*order).limit(per_class) for q in (0, 1)]
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    # At most 2 * per_class rows are sent out. A repeated id gives its smallest text.
    picked = texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    hashes = F.transform(F.slice(F.split("text", "\n"), 1, TRAIN_LINES), lambda x: F.xxhash64(F.trim(x)))
    picked = materialise(picked.withColumn("h", hashes), "labelled")
    shared = {r["h"] for r in shared_lines(texts, picked.select(F.explode("h").alias("h")).distinct()).collect()}

    def features(batches):
        for b in batches:
            rows = [line_features([t]) for t in b["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype(str), "quality": b["quality"], "x": [x[:TRAIN_LINES].astype(np.float32).ravel() for x, *_ in rows],
                    "words": [w[:TRAIN_LINES] for _, w, *_ in rows], "h": b["h"],
                }
            )

    kind = "doc_id string, quality int, x array<float>, words array<double>, h array<long>"
    rows = picked.mapInPandas(features, kind).toPandas().sort_values("doc_id")
    if rows["quality"].nunique() < 2:
        return None
    sequences = [np.asarray(r, np.float64).reshape(-1, FEATURES) for r in rows["x"]]
    words = [np.asarray(w, np.float64) for w in rows["words"]]
    repeated = [np.array([v in shared for v in h]) & (w > 0) for h, w in zip(rows["h"], words)]
    return fit_shares(sequences, words, rows["quality"].to_numpy() == 1, repeated)


def with_quality(docs: DataFrame, model: Crf | None, share: float = CONTENT_SHARE, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``quality_report`` (replacing one of that name): the counts, ``content_share`` and
    ``kept``. Rows are neither dropped nor merged, repeated ones are judged alike; a null text counts as empty, and so fails. Texts are
    taken whole. Labellings of equal score go to content. Without a model every line counts as content; an empty table gives an empty result."""

    @F.pandas_udf(COLUMNS)
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield judge(list(b), model, share)

    return docs.withColumn("quality_report", report.asNondeterministic()(F.col(text)))


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_quality(docs.select("doc_id", "text"), model).select("doc_id", "quality_report.*")
