"""URL filter and nearest neighbours."""

import numpy as np
from pyspark.sql import functions as F

from fieldgrant.llm import ann_tree, url_cascade

URLS = [
    (1, "http://A.Example.NET/en/x", "h"), (2, "https://example.net/en", "h"), (3, "https://example.net", "h"),
    (4, "x://net/", "h"), (5, "no scheme", "h"), (6, None, "h"), (7, "http://example.com/de/#a", "h"),
    (8, "http://notexample.com/de/", "h"), (9, "http://a.org/fr/?q=/", "h"), (10, "http://a.org?x=/fr/", "h"),
    (11, "http://...net//", "h"), (12, "://net/x", "h"), (None, "http://b.net/z", "h"), (13, "http://" + "a." * 500 + "net/" + "p" * 5000, "h"),
    (13, "http://b.net/z", "h"), (14, "", "h"), (15, "http://example.net:80/en/", "h"),
]


def brute(url, rules):
    scheme, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", None, "allow"
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_url_rules(spark, monkeypatch):
    pages = spark.createDataFrame(URLS, "page_id long, url string, host string")
    many = [(f"x{i}.net", "/", "block") for i in range(300)] + [("a.net", "", "allow"), ("net", "/z", "block"), ("net", "/z", "allow"), (None, "/", "block")]
    for rules in (list(url_cascade.RULES), list(url_cascade.RULES) + many, [], many[:2]):
        listed = spark.createDataFrame(rules, "host string, path string, verdict string")
        want = sorted(((i, *brute(u, [r for r in rules if r[0]])) for i, u, _ in URLS), key=repr)
        for limit in (url_cascade.MAX_LEVEL_BYTES, 200):
            monkeypatch.setattr(url_cascade, "MAX_LEVEL_BYTES", limit)
            found = url_cascade.filter_urls(pages, listed)
            assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
            assert sorted((tuple(r) for r in found.drop("url").collect()), key=repr) == want
    assert url_cascade.filter_urls(pages.limit(0), listed).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"))
    listed = spark.range(5000, 7000).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"))
    made = url_cascade.cascade(listed, keys)
    assert len(made.levels) > 1
    rows = keys.toPandas()
    found = made.listed(rows["h1"].to_numpy(), rows["h2"].to_numpy())
    assert (np.flatnonzero(found) == np.arange(5000, 7000)).all()


def neighbours(vectors, queries):
    return {
        q: [(r["vec_id"], r["score"]) for r in sorted(rows, key=lambda r: r["rank"])]
        for q, rows in _by_query(ann_tree.search(vectors, queries).collect()).items()
    }


def _by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append(r)
    return out


def test_nearest(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 600)]
    x[100:350] = x[100]  # one very frequent vector
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    odd = [(1000, None), (1050, []), (1100, [0.0] * 16), (1150, [float("nan")] * 16), (1200, [1.0, None] * 8), (1250, [float("inf")] + [1.0] * 15),
           (None, [1.0] * 16), (1300, [1.0] * 3), (0, [float(a) for a in x[0]]), (1350, [1e-300] * 16), (1400, [1e300] * 16)]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    queries = vectors.filter("vec_id % 50 = 0")
    for block in (ann_tree.BLOCK, 60):
        monkeypatch.setattr(ann_tree, "BLOCK", block)
        found = neighbours(vectors, queries)
        assert set(found) == {*range(0, 600, 50), 1350, 1400}
        hits = 0
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        for q in range(0, 600, 50):
            score = unit @ unit[q]
            score[q] = -9
            best = sorted(score)[-5]
            assert len(found[q]) == 5 and all(s <= 1 + 1e-9 for _, s in found[q])
            assert [s for _, s in found[q]] == sorted((s for _, s in found[q]), reverse=True)
            hits += sum(s >= best - 1e-9 for _, s in found[q])
        assert hits >= 0.9 * 5 * 12
        assert [v for v, _ in found[150]] == [100, 101, 102, 103, 104]
    assert ann_tree.search(vectors.limit(0), queries).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert {q: len(v) for q, v in neighbours(few, few).items()} == {0: 2, 1: 2, 2: 2}
    one = spark.createDataFrame(rows[:1], "vec_id long, embedding array<double>")
    assert ann_tree.search(one, one).count() == 0


def test_small_leaves_still_give_all_neighbours(spark, monkeypatch):
    """Queries whose nearest leaves hold few vectors go on to further leaves."""
    monkeypatch.setattr(ann_tree, "LEAF", 8)
    monkeypatch.setattr(ann_tree, "_calibrated", lambda *_: 1)
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(4, 8))[rng.integers(0, 4, 200)] + 0.01 * rng.normal(size=(200, 8)), 5 * rng.normal(size=(40, 8))])
    vectors = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours(vectors, vectors)
    assert set(found) == set(range(240)) and {len(v) for v in found.values()} == {5}


def test_calibration_on_distinct_vectors(monkeypatch):
    seen = []
    monkeypatch.setattr(ann_tree, "_calibrated", lambda tree, unit, *_: seen.append(len(unit)) or 1)
    x = np.random.default_rng(4).normal(size=(50, 6))
    ann_tree.fit(np.concatenate([x, np.repeat(x[:1], 500, axis=0)]))
    assert seen == [50]


def test_extra_columns_of_any_name_stay(spark):
    """Names that the operators use themselves."""
    from fieldgrant.llm import language

    names = ("_best", "_keys", "_codes", "_row", "_found", "key", "h1")
    pages = spark.createDataFrame([(1, "http://a.net/x", *names)], "page_id long, url string, " + ", ".join(f"{n} string" for n in names))
    listed = spark.createDataFrame(list(url_cascade.RULES), "host string, path string, verdict string")
    for rules in (listed, listed.limit(0)):
        found = url_cascade.filter_urls(pages, rules)
        assert found.columns == ["page_id", "url", *names, "host", "path", "rule", "verdict"]
        assert found.select(*names).first() == names
    found = language.identify(pages.withColumnRenamed("url", "text"), None)
    assert found.columns == ["page_id", "text", *names, "lang_pred", "score"] and found.select(*names).first() == names
