"""URL filter by a cascade of Bloom filters.

Level 0 holds the listed keys, level 1 those keys of the corpus that level 0 takes for listed, level
2 the listed keys that level 1 takes for such, and so on until nothing is mistaken. A key of the
corpus is listed exactly if the first level that lacks it is an odd one (or if it passes all levels
and the last is even). The pages are never joined with the list.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from .text import ascii_lower

#: Bytes of one level that the driver gathers and sends out; longer lists are filtered in several passes.
MAX_LEVEL_BYTES = 16 << 20
MAX_LEVELS = 60

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    x = h + np.uint64((salt * _MIX[0] + _MIX[0]) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


def positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit positions, one row per key, one column per hash function."""
    a, b = _mixed(h1.astype(np.uint64), 2 * level), _mixed(h2.astype(np.uint64), 2 * level + 1) | np.uint64(1)
    return np.stack([(a + np.uint64(k) * b) % np.uint64(bits) for k in range(hashes)], axis=1)


@dataclass
class Level:
    """One Bloom filter: ``words`` of 64 bits."""

    number: int
    bits: int
    hashes: int
    words: np.ndarray

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = positions(h1, h2, self.number, self.bits, self.hashes)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


@dataclass
class Cascade:
    """Exact membership for the keys of the corpus it was made over."""

    levels: list[Level] = field(default_factory=list)

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        result = np.zeros(len(h1), bool)
        rest = np.arange(len(h1))
        for i, level in enumerate(self.levels):
            held = level.holds(h1[rest], h2[rest])
            result[rest[~held]] = i % 2 == 1
            rest = rest[held]
        result[rest] = len(self.levels) % 2 == 1
        return result


def _shape(n: int, rate: float) -> tuple[int, int]:
    hashes = max(1, round(-math.log2(rate)))
    return max(64, math.ceil(n * hashes / math.log(2))), hashes


def _level(keys: DataFrame, n: int, number: int, rate: float) -> Level:
    """The filter over ``keys`` (h1, h2). Bits are gathered as 64-bit words, combined before the shuffle."""
    bits, hashes = _shape(n, rate)

    def words(batches):
        for x in batches:
            at = positions(x["h1"].to_numpy(), x["h2"].to_numpy(), number, bits, hashes).ravel()
            one = np.left_shift(np.uint64(1), at & np.uint64(63)).astype(np.int64)
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64), "bit": one})

    rows = keys.mapInPandas(words, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    held = np.zeros(bits // 64 + 1, np.uint64)
    held[rows["word"].to_numpy()] = rows["bit"].to_numpy().astype(np.uint64)
    return Level(number, bits, hashes, held)


def _mistaken(keys: DataFrame, level: Level) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(level)

    def held(batches):
        for x in batches:
            yield x[sent.value.holds(x["h1"].to_numpy(), x["h2"].to_numpy())]

    return keys.mapInPandas(held, keys.schema)


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade for ``listed`` keys against all keys of the corpus, both distinct (h1, h2)."""
    n, total = listed.count(), universe.count()
    made = Cascade()
    inside = listed
    # The first rate balances the sizes of the first two levels; later ones halve what is mistaken.
    rate = min(0.5, max(1e-9, math.sqrt(0.5) * n / max(1, total)))
    while n and len(made.levels) < MAX_LEVELS:
        level = _level(inside, n, len(made.levels), rate)
        made.levels.append(level)
        if level.number == 0:
            against = _mistaken(universe, level).join(listed, ["h1", "h2"], "left_anti")
        else:
            against = _mistaken(against, level)
        against = materialise(against, "mistaken")
        inside, against = against, inside
        n, rate = inside.count(), 0.5
    if n:
        raise ValueError("keys with equal 128-bit hashes")
    return made


def _hashes(key):
    return F.xxhash64(key), F.xxhash64(F.lit(7), key)


def url_parts(url) -> tuple:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    host = ascii_lower(F.regexp_extract(url, _URL, 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def candidate_keys(host, path, labels: int, lengths: list[int]):
    """Array of host suffix + path prefix, for suffixes of up to ``labels`` labels and prefixes of ``lengths``."""
    parts = F.split(host, r"\.")
    last = F.slice(parts, F.greatest(F.lit(1), F.size(parts) - labels + 1), F.lit(labels))
    hosts = F.transform(F.sequence(F.lit(1), F.size(last)), lambda i: F.array_join(F.slice(last, i, F.lit(labels)), "."))
    fits = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    paths = F.array_compact(F.array(*fits))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict (earlier columns of these names are replaced).

    ``rules`` has host, path and verdict (allow or block); a rule fits its host and all subdomains if
    the URL's path starts with the rule's path. The longest fitting rule string wins, of equal ones that
    with the longer host; a rule listed with both verdicts blocks. URLs without a fitting rule, null
    and malformed ones among them, get a null rule and ``default``. Rules with a null are ignored; an
    empty rule or page table is no error. Rows are neither dropped nor merged. The driver holds one level of one cascade
    at a time per verdict; longer lists are handled in passes over ranges of hashes.
    """
    spark = pages.sparkSession
    listed = rules.select(
        F.concat(ascii_lower(F.col("host")), "path").alias("key"), "verdict",
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length"),
    ).filter("key is not null")
    listed = listed.withColumn("h1", _hashes("key")[0]).withColumn("h2", _hashes("key")[1])
    about = listed.agg(
        F.max("labels").alias("labels"), F.collect_set("length").alias("lengths"), F.count(F.lit(1)).alias("n")
    ).first()
    host, path = url_parts(F.col(url))
    # Rows are kept in one column, so that none of their names can clash with those used here.
    own = [F.col("_row")[c].alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    pages = pages.select(F.struct("*").alias("_row"), host.alias("host"), path.alias("path"))
    if not about["n"]:
        return pages.select(*own, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = candidate_keys(F.col("host"), F.col("path"), about["labels"], sorted(about["lengths"]))
    universe = pages.select(F.explode(keys).alias("key")).select(*[h.alias(n) for h, n in zip(_hashes("key"), ("h1", "h2"))])
    universe = materialise(universe.distinct(), "universe")
    first_bytes = _shape(about["n"], min(0.5, max(1e-9, 0.7 * about["n"] / max(1, universe.count()))))[0] // 8
    passes = max(1, math.ceil(first_bytes / MAX_LEVEL_BYTES))
    best = F.lit(None).cast("struct<size:int,host:int,key:string,code:int>")
    out = pages.withColumn("_best", best)
    for turn in range(passes):
        mine = F.pmod(F.col("h1"), F.lit(passes)) == turn
        made = [
            cascade(listed.filter(mine & (F.col("verdict") == v)).select("h1", "h2").distinct(), universe.filter(mine))
            for v in ("allow", "block")
        ]
        out = _probed(spark, out, keys, made, turn, passes)
        if turn + 1 < passes:
            out = materialise(out, "probed")
    verdict = F.when(F.col("_best.code") == 2, "block").when(F.col("_best.code") == 1, "allow").otherwise(default)
    return out.select(*own, "host", "path", F.col("_best.key").alias("rule"), verdict.alias("verdict"))


def _probed(spark: SparkSession, pages: DataFrame, keys, cascades: list[Cascade], turn: int, passes: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("array<int>")
    def codes(firsts: pd.Series, seconds: pd.Series) -> pd.Series:
        """For each candidate key 2 if it is to block, 1 if it is to allow, else 0."""
        sizes = [len(x) for x in firsts]
        if not sum(sizes):
            return pd.Series([[] for _ in sizes])
        h1 = np.concatenate(list(firsts)).astype(np.int64)
        h2 = np.concatenate(list(seconds)).astype(np.int64)
        allow, block = (c.listed(h1, h2) for c in sent.value)
        found = np.where(block, 2, np.where(allow, 1, 0)).astype(np.int32)
        found[h1 % passes != turn] = 0
        return pd.Series(np.split(found, np.cumsum(sizes)[:-1]))

    probed = pages.withColumn("_keys", keys)
    hashed = F.transform("_keys", lambda k: _hashes(k)[0]), F.transform("_keys", lambda k: _hashes(k)[1])
    probed = probed.withColumn("_codes", codes(*hashed))
    hits = F.filter(F.arrays_zip("_keys", "_codes"), lambda x: x["_codes"] > 0)
    ranked = F.transform(
        hits,
        lambda x: F.struct(
            F.length(x["_keys"]).alias("size"),
            (F.instr(F.concat(x["_keys"], F.lit("/")), "/")).alias("host"),
            x["_keys"].alias("key"),
            x["_codes"].alias("code"),
        ),
    )
    return probed.withColumn("_best", F.greatest(F.col("_best"), F.array_max(ranked))).drop("_keys", "_codes")


#: The rules of the registered query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_MATCHES = " OR ".join(
    f"(r.host = '{h}' AND (p.host = '{h}' OR p.host LIKE '%.{h}') AND starts_with(p.path, r.path))" for h, _, _ in RULES
)
OP1_SQL = f"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS n,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
fits AS (
  SELECT p.n, max(struct_pack(size := length(r.host || r.path), key := r.host || r.path, verdict := r.verdict)) AS best
  FROM parts p JOIN rules r ON {_MATCHES} GROUP BY p.n)
SELECT page_id, host, path, best.key AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (n)
"""
