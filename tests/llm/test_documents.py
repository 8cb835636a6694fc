"""Operators on documents against brute force, on rows with every kind of oddity."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fieldgrant.llm import byte_bpe, language, line_dedup, mixing, quality_crf, simhash, suffix_dedup, token_files
from fieldgrant.llm.components import connected

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def components(n, pairs):
    label = list(range(n))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        label[b] = a
    return [top(i) for i in range(n)]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r["root"]].add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(61)), list(range(100, 140))]
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# Quality -----------------------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(zip(found, found[1:], found[2:]))
    inside = set()
    for i, w in enumerate(zip(found, found[1:], found[2:])):
        if windows[w] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(found)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_quality_counts(odd, odd_rows, nothing):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality_crf.with_quality(odd, None).select("doc_id", *[f"quality_report.{c}" for c in names], "quality_report.kept")
    want = [(r[0], *brute_counts(r[1]), not brute_counts(r[1])[-1]) for r in odd_rows]
    assert rows_of(found, "*") == sorted(want, key=repr)
    assert quality_crf.with_quality(nothing, None).count() == 0


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    model = quality_crf.Crf(np.zeros(16), rng.normal(size=(2, 2)), rng.normal(size=2), np.zeros(16), np.ones(16))
    lengths = np.array([1, 4, 7, 2])
    e = rng.normal(size=lengths.sum())
    found, at = quality_crf.viterbi(model, e, lengths), 0
    for n in lengths:
        def score(path, at=at, n=n):
            s = model.first[path[0]] + sum(e[at + i] for i in range(n) if path[i])
            return s + sum(model.between[a, b] for a, b in zip(path, path[1:]))
        best = max((tuple(int(b) for b in f"{k:0{n}b}") for k in range(2**n)), key=score)
        assert tuple(found[at : at + n]) == best
        at += n


def test_crf_likelihood_against_all_paths():
    """Value and gradient, from every labelling of every document."""
    rng = np.random.default_rng(12)
    lengths, f = [1, 3, 5, 2], quality_crf.FEATURES
    lines = quality_crf._Lines(np.zeros((5, 4, f)), np.zeros((5, 4), bool), np.zeros((5, 4), np.int64))
    for i, n in enumerate(lengths):
        lines.x[:n, i], lines.live[:n, i], lines.y[:n, i] = rng.normal(size=(n, f)), True, rng.integers(0, 2, n)

    def plain(flat):
        w, between, first = flat[:f], flat[f : f + 4].reshape(2, 2), flat[-2:]
        total = 0.0
        for i, n in enumerate(lengths):
            def score(y):
                s = first[y[0]] + sum((lines.x[t, i] @ w) * y[t] for t in range(n))
                return s + sum(between[y[t - 1], y[t]] for t in range(1, n))

            total += score(lines.y[:n, i]) - np.log(sum(np.exp(score(y)) for y in itertools.product((0, 1), repeat=n)))
        return total

    flat = rng.normal(size=f + 6) / 2
    value, gradient = quality_crf.likelihood(flat, lines)
    assert value == pytest.approx(plain(flat))
    for j in range(len(flat)):
        step = np.zeros(len(flat))
        step[j] = 1e-5
        assert gradient[j] == pytest.approx((plain(flat + step) - plain(flat - step)) / 2e-5, abs=1e-5)


def test_crf_fit_is_at_the_top_of_the_likelihood():
    rng = np.random.default_rng(13)
    x = [np.c_[np.ones(6), rng.normal(size=(6, quality_crf.FEATURES - 1))] for _ in range(40)]
    y = [(s[:, 1] + rng.normal(size=6) > 0).astype(int) for s in x]
    ridge = 0.05
    model = quality_crf.fit(x, y, steps=3_000, rate=0.02, ridge=ridge)
    lines = quality_crf._Lines(np.stack([((s - model.mean) / model.scale) for s in x], axis=1), np.ones((6, 40), bool), np.stack(y, axis=1))
    flat = np.concatenate([model.weights, model.between.ravel(), model.first])
    assert abs(quality_crf.likelihood(flat, lines)[1] / 240 - ridge * flat).max() < 1e-3


def test_lines_of_their_own_labels_are_found(spark):
    """Good documents with known boilerplate inside, bad ones with some content; only the documents are labelled."""
    rng = random.Random(14)

    def prose():
        return " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(12, 30))).capitalize() + "."

    def menu():
        return " | ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randint(3, 8))).title() for _ in range(rng.randint(5, 14)))

    share = ["Home | About | Contact | Terms | Login", "Share on: Facebook | Twitter | Mail | Print"]
    docs, truth, labels = [], {}, []
    for i in range(300):
        good = i % 2
        kinds = [rng.random() < (0.3 if good else 0.75) for _ in range(12)]
        kinds[0] = not good  # at least one of the other sort
        if (sum(kinds) < 6) != good:
            kinds = [not good] * 7 + [bool(good)] * 5
        lines = [rng.choice(share) if k and rng.random() < 0.3 else menu() if k else prose() for k in kinds]
        words = [len(line.replace("|", " ").split()) if k else len(line.split()) for line, k in zip(lines, kinds)]
        if (sum(w for w, k in zip(words, kinds) if not k) >= sum(words) / 2) != good:
            continue
        docs.append((i, "\n".join(lines)))
        labels.append((i, good))
        truth[i] = kinds
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = quality_crf.train(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    right = total = mixed = 0
    for i, text in docs:
        x = quality_crf.line_features([text])[0]
        found = quality_crf.viterbi(model, model.emissions(x), np.array([len(x)]))
        right += sum(a == b for a, b in zip(found, truth[i]))
        total += len(found)
        mixed += 0 < found.sum() < len(found)
    assert right >= 0.9 * total and mixed >= 0.9 * len(docs)


def test_copies_of_a_document_are_no_shared_lines(spark):
    docs = [(f"a\nb{i}\nfooter\nc{i}",) for i in range(4)] + [("x\ny\nz",)] * 50 + [(None,), ("",)]
    frame = spark.createDataFrame(docs, "text string")
    wanted = spark.createDataFrame([(t,) for t in ("a", "footer", "x", "y", "z", "b1", "")], "t string").select("t", F.xxhash64("t").alias("h"))
    found = quality_crf.shared_lines(frame, wanted.select("h")).join(wanted, "h")
    assert sorted(r.t for r in found.collect()) == ["a", "footer"]


def test_crf_learns_marked_lines(spark, odd):
    clean = "Plain words make a calm and even line of text here.\nAnother one follows it, as calm as the first was."
    noise = "BUY!! NOW!! ### $$$ CHEAP!!\n%%% &&& CLICK!! HERE!!"
    docs = spark.createDataFrame([(i, clean if i % 2 else noise) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    model = quality_crf.train(docs, labels)
    share = {r["doc_id"]: r["s"] for r in quality_crf.with_quality(docs, model).select("doc_id", F.col("quality_report.content_share").alias("s")).collect()}
    assert all((share[i] > 0.5) == bool(i % 2) for i in range(40))
    assert quality_crf.train(docs, labels.limit(0)) is None
    assert quality_crf.train(odd, labels.filter("quality = 1")) is None


# Lines -------------------------------------------------------------------------------------------


def brute_lines(rows):
    """Rows alike in id and text are one; fingerprints, links and groups by comparing every two lines."""
    mask = (1 << 64) - 1
    seen = {}
    for i, text in rows:
        if text is not None:
            seen[i, text] = [re.sub(r"[\W_]+", " ", x.lower()).strip() for x in text.split("\n")]
    lines = sorted({x for v in seen.values() for x in v if x})

    def code(line):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) & mask for w in dict.fromkeys(line.split(" "))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    codes = [code(x) for x in lines]
    pairs = []
    for a, b in combinations(range(len(lines)), 2):
        if (codes[a] ^ codes[b]).bit_count() <= 3:
            x, y = lines[a].split(" "), lines[b].split(" ")
            if edits(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                pairs.append((a, b))
    root = dict(zip(lines, components(len(lines), pairs)))
    return {k: [root.get(x) for x in v] for k, v in seen.items()}, pairs


def test_line_dedup_against_brute_force(spark, odd, odd_rows, nothing):
    rows = [(r[0], r[1]) for r in odd_rows if r[1] is None or len(r[1]) < 100_000]
    rows += [(100 + i, "alpha beta gamma delta " * 6 + f"{'x' * (i % 3)} end {w}") for i, w in enumerate("abcdefgh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.dedup_lines(docs, distance=line_dedup.DISTANCE).collect()
    assert len(found) == len(rows)
    roots, pairs = brute_lines(rows)
    assert pairs
    kept = {}
    for (i, text), line_roots in roots.items():
        kept[i, text] = line_roots
    # Each group keeps exactly one line among different documents, and lines without a word stay.
    total = Counter()
    groups = {r for v in kept.values() for r in v if r is not None}
    left = defaultdict(int)
    seen = set()
    for r in found:
        if r["text"] is not None and (r["doc_id"], r["text"]) not in seen:
            seen.add((r["doc_id"], r["text"]))
            left[r["doc_id"]] += sum(1 for x in r["text"].split("\n") if re.search(r"[^\W_]", x))
    total = sum(left.values())
    assert total == len(groups)
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert line_dedup.dedup_lines(odd).columns == odd.columns


@pytest.mark.parametrize("hot", [line_dedup.HOT, 1])
def test_line_dedup_by_edit_similarity_alone(spark, odd_rows, monkeypatch, hot):
    """Every two lines are compared; no pair may be missed, however far apart their fingerprints are."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdeinorst"), rng.integers(1, 9))) for _ in range(400)]
    lines = [line for r in odd_rows if r[1] is not None and len(r[1]) < 5_000 for line in r[1].split("\n")]
    for n in (1, 3, 4, 5, 6, 8, 12, 20, 40, 60, 100):
        for share in (0.05, 0.1, 0.15, 0.2, 0.25):
            old = list(rng.choice(vocabulary, n))
            new = list(old)
            for _ in range(max(1, round(share * n))):
                at, word = int(rng.integers(len(new) + 1)), str(rng.choice(vocabulary))
                kind = int(rng.integers(3))
                new = new[:at] + [word] * (kind < 2) + new[at + (kind > 0) :]
            lines += [" ".join(old), " ".join(new)]
    lines += ["a a a a a a a a a b", "a a a a a a a a a c", "b a a a a a a a a", "x y x y x y x y x y", "x y x y x y x y x z"]
    lines = [line for line in lines if len(line) < 5_000]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(docs).collect()}
    normal = [re.sub(r"[\W_]+", " ", x.lower()).strip() for x in lines]
    words_of = [x.split(" ") for x in normal]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    pairs = []
    for i, j in combinations([i for i, x in enumerate(normal) if x], 2):
        a, b = words_of[i], words_of[j]
        most = 0.2 * max(len(a), len(b)) + 1e-9
        # Cheap exact bounds first.
        if abs(len(a) - len(b)) <= most and max(len(a), len(b)) - (Counter(a) & Counter(b)).total() <= most and edits(a, b) <= most:
            pairs.append((i, j))
    root = components(len(lines), pairs)
    first = {}
    for i, r in enumerate(root):
        first[r] = min(first.get(r, i), i)
    want = {i: [0] for i, r in enumerate(root) if normal[i] and first[r] != i}
    assert len(want) > 40
    assert found == want


def test_unlike_long_lines_are_told_apart_before_they_are_compared(spark, monkeypatch):
    """Lines of 50 to 220 words without a word in common: their codes must tell them apart, or all pairs that meet are shuffled and compared. Near
    copies of them, also of lengths about WIDE, stay possible."""
    sizes = [50, 60, *range(line_dedup.WIDE - 5, line_dedup.WIDE + 6), 100, 120, 150, 180, 200, 220]
    lines = [" ".join(f"w{k}x{n}x{i}" for i in range(n)) for k in range(2) for n in sizes]
    near = [line.replace(f"w{k % 2}", "changed ", 1) for k, line in enumerate(lines)]
    docs = spark.createDataFrame(list(enumerate(lines + near)), "doc_id long, text string")
    rows = line_dedup.marked(docs).select("doc_id", "code").cache()
    x, y = rows.alias("x"), rows.alias("y")
    both = x.join(y, F.col("x.doc_id") < F.col("y.doc_id")).filter(line_dedup._possible("x.code", "y.code", line_dedup.SIMILARITY))
    found = {(r[0], r[1]) for r in both.select("x.doc_id", "y.doc_id").collect()}
    own = {(i, i + len(lines)) for i in range(len(lines))}
    assert own <= found
    assert len(found - own) <= 10
    rows.unpersist()


def test_line_search_shuffles_a_part_of_the_buckets_at_a_time(spark, monkeypatch):
    """The search for neighbours goes through the buckets in turns, whose results are stored one by one."""
    names, stored = [], line_dedup._stored
    monkeypatch.setattr(line_dedup, "_stored", lambda df, name: names.append(name) or stored(df, name))
    docs = spark.createDataFrame([(i, f"alpha beta gamma delta epsilon zeta eta {i % 2} theta iota") for i in range(4)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in line_dedup.removed_lines(docs).collect()) == [1, 2, 3]
    assert names.count("near") == line_dedup.TURNS > 1


def test_line_similarity_in_words(spark):
    """The cheap tests before the last count of edits decide as it does."""
    base = [f"w{i}" for i in range(40)]
    rows = []
    for n in range(0, 14):
        rows += [(" ".join(base), " ".join([f"new{i}" for i in range(n)] + base[n:])), (" ".join(base), " ".join(base[n:]))]
        rows += [(" ".join(base), " ".join(base[n:] + base[:n])), (" ".join(base[:10] * 4), " ".join(base[:10] * 3 + base[10 - n % 10 :]))]
    found = spark.createDataFrame(rows, "a string, b string").select("a", "b", line_dedup.similar(line_dedup.signs(F.col("a")), line_dedup.signs(F.col("b"))).alias("s"))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    told = {(r["a"], r["b"]): r["s"] for r in found.collect()}
    want = {(a, b): edits(a.split(), b.split()) <= 0.2 * max(len(a.split()), len(b.split())) + 1e-9 for a, b in rows}
    assert told == want and {True, False} == set(want.values())


def test_line_dedup_plan_has_no_python(spark, odd):
    plan = line_dedup.occurrences(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# Passages ----------------------------------------------------------------------------------------


def brute_repeats(texts, length=suffix_dedup.LENGTH):
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                mask[i + 1 : i + length + 1] = True
        kept = bytes(b for b, m in zip(t, mask[1:]) if not m)
        spans = int((mask[1:] & ~mask[:-1]).sum())
        out.append((len(t), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order():
    rng = np.random.default_rng(5)
    for trial in range(60):
        data = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 200)).astype(np.uint8)
        depth = int(rng.choice([3, 8, 20, 400]))
        whole = data.tobytes()
        order = suffix_dedup.suffix_order(data, depth)
        assert sorted(order) == list(range(len(whole)))
        assert [whole[i : i + depth] for i in order] == sorted(whole[i : i + depth] for i in range(len(whole)))


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_repeats_against_brute_force(odd, odd_rows, nothing, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "_SCAN", 1500)
    found = suffix_dedup.remove_repeats(odd)
    want = [(r[0], *w) for r, w in zip(odd_rows, brute_repeats([(r[1] or "").encode() for r in odd_rows]))]
    assert rows_of(found, "*") == sorted(want, key=repr)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


# Mixing ------------------------------------------------------------------------------------------


def test_repeats_of_a_frequent_passage_meet_in_small_parts(spark, monkeypatch):
    """Passages that many documents share, each with other text around: equal pieces are merged, and different ones cut finer."""
    monkeypatch.setattr(suffix_dedup, "HOT", 4)
    rng = np.random.default_rng(9)

    def other(n):
        return "".join(rng.choice(list("abcdefgh"), n))

    long, short = other(700), other(380)
    texts = [other(300) + long + other(300) for _ in range(30)] + [other(500) + short + other(500) for _ in range(30)]
    texts += [other(200) + short + "z" * 20 + other(200) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    parts = suffix_dedup._parts

    def watched(*args):
        seen.append(parts(*args))
        return seen[-1]

    monkeypatch.setattr(suffix_dedup, "_parts", watched)
    found = suffix_dedup.remove_repeats(docs)
    want = [(i, *w) for i, w in enumerate(brute_repeats([t.encode() for t in texts]))]
    assert rows_of(found, "*") == sorted(want, key=repr)
    sizes = [r["count"] for r in seen[0][0].groupBy("part").count().collect()]
    assert max(sizes, default=0) <= 4 and seen[0][1].count() >= 30


def test_targets():
    assert mixing.targets([], []) == []
    assert mixing.targets([0, 0], [3, 1]) == [0, 0]
    found = mixing.targets([10, 100, 100], [3, 1, 2])
    assert found[0] == 20 and sum(found) == pytest.approx(315) and found[2] == pytest.approx(2 * found[1]) and max(found) <= 200
    assert mixing.targets([10, 20], [1, 1], share=2) == [20, 40]


def test_split_keeps_quotas():
    quotas = np.array([0, 7, 1024, 300])
    dealt = mixing.split_quotas(quotas, 7, seed=1)
    assert (dealt.sum(axis=0) == quotas).all() and dealt.min() >= 0
    assert abs(dealt.sum(axis=1) - quotas.sum() / 7).max() <= 2
    assert (dealt == mixing.split_quotas(quotas, 7, seed=1)).all()


def test_mixing(spark, odd, odd_rows, nothing):
    found = mixing.assignments(odd)
    rows = found.collect()
    sizes = sorted(len(WORD.findall(r[1] or "")) for r in odd_rows)
    assert sorted(r["size"] for r in rows) == sizes
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    assert rows_of(found, "*") == rows_of(mixing.assignments(odd.repartition(3)), "*")
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect()) == sum(r["taken"] for r in rows)
    assert mixing.assignments(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    by = mixing.assignments(many).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) < 100 for r in by)


def plain_mix(keyed, shards):
    """Copies of each row by shard, from (source, size, hash, place of its block), written out block by block."""
    names = sorted({k[0] for k in keyed}, key=lambda s: (s is None, s or ""))
    wanted = mixing.targets([sum(k[1] for k in keyed if k[0] == s) for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    drawn = {}  # source -> the blocks it gives, in order, each as the rows in it
    for s, t in zip(names, wanted):
        blocks = [[i for i, k in enumerate(keyed) if k[0] == s and k[3] == place] for place in range(mixing.BLOCKS)]
        size = sum(k[1] for k in keyed if k[0] == s)
        drawn[s], need = [], t
        while size and need >= size:
            drawn[s] += blocks
            need -= size
        for rows in blocks if size and need > 0 else []:
            words = sum(keyed[i][1] for i in rows)
            if words > need:
                last, upto = [], 0
                for h in sorted({keyed[i][2] for i in rows}):
                    alike = [i for i in rows if keyed[i][2] == h]
                    w = sum(keyed[i][1] for i in alike)
                    upto += w
                    if upto - w / 2 > need:
                        break
                    last += alike
                drawn[s] += [last] if last else []
                break
            drawn[s].append(rows)
            need -= words
    dealt = mixing.split_quotas(np.array([len(drawn[s]) for s in names], np.int64), shards) if names else np.zeros((shards, 0), int)
    out, taken = [[] for _ in keyed], {s: 0 for s in names}
    for shard in range(shards):
        for s, n in zip(names, dealt[shard]):
            for rows in drawn[s][taken[s] : taken[s] + n]:
                for i in rows:
                    out[i].append(shard)
            taken[s] += n
    return out


@pytest.mark.parametrize("blocks", [1024, 8])
def test_mixing_against_a_plain_version(spark, odd, tmp_path, monkeypatch, blocks):
    monkeypatch.setattr(mixing, "BLOCKS", blocks)
    empty = spark.createDataFrame([(1000 + i, " " * i, "en", f"s{i % 3}", i, "x", None) for i in range(40)], odd.schema)
    some = odd.union(empty)
    some.write.parquet(f"{tmp_path}/documents.parquet")
    found = mixing.op5_mixing(spark, str(tmp_path))
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken", "shards"]
    keyed = [tuple(r) for r in mixing._keyed(some, F.col("doc_id")).select("source", "_size", "_h", "_pos", "doc_id").collect()]
    draws = plain_mix(keyed, mixing.SHARDS)
    want = sorted(((k[4], k[1], k[1] * len(d), d) for k, d in zip(keyed, draws)), key=repr)
    assert sorted(((r.doc_id, r.size, r.taken, r.shards) for r in found.collect()), key=repr) == want
    assert all(len(d) <= mixing.MOST for d in draws)
    mixed = Counter(r.doc_id for r in mixing.mix(some).collect())
    assert mixed == Counter({k: n for k, n in sum((Counter({i: len(s)}) for i, *_, s in want), Counter()).items() if n})


def test_mix_is_dealt_to_tasks_in_even_runs(spark, monkeypatch):
    """No task takes a shard whole, and the shards' order is the one that they have uncut."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 10).alias("text"), F.lit("s").alias("source"))
    whole = [[r.doc_id for r in p] for p in mixing.mix(rows).rdd.glom().collect()]
    monkeypatch.setattr(mixing, "SLICE_WORDS", 1000)
    parts = [[r.doc_id for r in p] for p in mixing.mix(rows).rdd.glom().collect()]
    slices = len(parts) // mixing.SHARDS
    assert slices > 1 and len(whole) == mixing.SHARDS
    assert [sum(parts[i * slices : (i + 1) * slices], []) for i in range(mixing.SHARDS)] == whole
    assert max(map(len, parts)) * 10 < 2 * 1000


def test_shards_draw_disjoint_blocks(spark, odd):
    docs = mixing._keyed(odd.repartition(4), F.col("doc_id"))
    plan = mixing.plan_mix(docs, 5)
    draws = mixing.with_draws(docs, plan).select("source", F.explode("_draws").alias("d")).select("source", "d.*")
    assert draws.groupBy("source", "index").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


# Tokens ------------------------------------------------------------------------------------------


def test_token_files_round_trip(spark, odd, odd_rows, nothing, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    name = public_tokenizers.path("byte_bpe_50k.json")
    with open(name, encoding="utf-8") as f:
        definition = f.read()
    reference = Tokenizer.from_file(name)
    token_files.write(odd, definition, str(tmp_path / "t"))
    found = token_files.read(spark, str(tmp_path / "t")).orderBy("start", "n_tokens").collect()
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in odd_rows), key=lambda i: (i is not None, i))
    at, want = 0, Counter()
    for _, text, *_ in odd_rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids + [0]
        want[len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    assert Counter((r["n_tokens"], r["ids_crc32"]) for r in found) == want
    token_files.write(nothing, definition, str(tmp_path / "n"))
    assert token_files.read(spark, str(tmp_path / "n")).count() == 0


def test_elias_fano_select():
    for values in ([], [0], [5], [0, 0, 0], list(range(1000)), sorted(np.random.default_rng(1).integers(0, 10**9, 700).tolist())):
        made = token_files.EliasFano.of(np.array(values, np.uint64))
        assert made.values().tolist() == values
        assert [made.select(i) for i in range(0, len(values), 7)] == values[::7]
    ids = np.arange(10, dtype=np.uint16)
    segment = token_files.Segment.parse(token_files.pack(ids, np.array([3, 3, 10])))
    assert [segment.document(i).tolist() for i in range(3)] == [[0, 1, 2], [], list(range(3, 10))]
    with pytest.raises(ValueError):
        token_files.Segment.parse(token_files.pack(ids, np.array([10]))[:-1] + b"x")


def test_byte_bpe_equals_library(spark, odd, odd_rows, nothing):
    import tiktoken

    ranks, pattern = byte_bpe.public_ranks()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(ranks), special_tokens={})
    want = []
    for r in odd_rows:
        ids = library.encode_ordinary(r[1] or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r[0], len(ids), listed, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert rows_of(byte_bpe.digests(odd, ranks, pattern), "*") == sorted(want, key=repr)
    decoded = byte_bpe.decode(byte_bpe.encode(odd, ranks, pattern), ranks, pattern)
    assert decoded.filter(F.col("decoded").cast("string") != F.coalesce("text", F.lit(""))).count() == 0
    both = byte_bpe.round_trip(odd, ranks, pattern)
    assert rows_of(both.select("doc_id", F.decode("decoded", "UTF-8").alias("t")), "*") == sorted(((r[0], r[1] or "") for r in odd_rows), key=repr)
    assert byte_bpe.digests(nothing, ranks, pattern).count() == 0


def test_byte_bpe_keeps_ids_as_bytes_and_beginnings_of_pieces():
    """Word by word as by the pattern over the whole text; what is remembered is nothing that Python's garbage collector goes through."""
    ranks, pattern = byte_bpe.public_ranks()
    encoder = byte_bpe.TextEncoder(byte_bpe.read_ranks(ranks), pattern)
    odd = ["a's", "don't,", "x'", "é.", "two", "日本。", "ⅷ.", "ª,", "ok..", "3rd,", "a)b", '"q"', "(p)", "A.\n\nB!", "unforeseenly,", "unforeseeable."]
    rng = random.Random(3)
    for _ in range(200):
        text = " ".join(rng.choice(odd) for _ in range(20))
        want = [i for p in encoder.find(text) for i in byte_bpe.PrefixBpe.piece(encoder.bpe, p.encode())]
        assert encoder.encode(text) == want and encoder.ids(text).tolist() == want
    assert all(isinstance(v, bytes) for v in (*encoder.first.values(), *encoder.later.values()))
    assert encoder.bpe.heads


def test_byte_bpe_appends_and_edits():
    import random

    rng = random.Random(2)
    bpe = byte_bpe.PrefixBpe(byte_bpe.read_ranks(byte_bpe.public_ranks()[0]))
    for _ in range(300):
        data = bytes(rng.choice(b"abetinorsh \xc3\xa9") for _ in range(rng.randint(0, 80)))
        kept = byte_bpe.Editable(bpe, data[:20])
        kept.append(data[20:])
        assert kept.ids() == bpe.piece(data)
        a = rng.randint(0, len(data))
        z = rng.randint(a, len(data))
        new = bytes(rng.choice(b"abeting") for _ in range(rng.randint(0, 6)))
        kept.replace(a, z, new)
        assert kept.data == data[:a] + new + data[z:] and kept.ids() == bpe.piece(kept.data)


# Near-duplicates ---------------------------------------------------------------------------------


def brute_code(text, size=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(lowered)
    if not found:
        return 0
    shingles = [" ".join(found[k : k + size]) for k in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(odd, odd_rows, nothing):
    codes = [brute_code(r[1]) for r in odd_rows]
    pairs = [(a, b) for a, b in combinations(range(len(codes)), 2) if (codes[a] ^ codes[b]).bit_count() <= 4]
    root = components(len(codes), pairs)
    least = {}
    for r, k in zip(odd_rows, root):
        if r[0] is not None:
            least[k] = min(least.get(k, r[0]), r[0])
    want = [(r[0], f"{c:016x}", least.get(k)) for r, c, k in zip(odd_rows, codes, root)]
    assert rows_of(simhash.near_duplicates(odd), "*") == sorted(want, key=repr)
    kept = simhash.keep_one(odd)
    assert kept.count() == len(set(root)) and kept.columns == odd.columns
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_gray_index_and_forest():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2**63, 400, dtype=np.uint64)
    x = np.unique(np.concatenate([x, x[:200] ^ np.uint64(5), x[:100] ^ np.uint64(1 << 40)]))
    x = x[np.argsort(simhash.gray_rank(x))]
    far = np.bitwise_count(x[:, None] ^ x[None, :])
    q, m = simhash.GrayIndex(x).search(x, 4)
    assert set(zip(q.tolist(), m.tolist())) == {(int(a), int(b)) for a, b in zip(*np.nonzero(far <= 4))}
    a, b = simhash.links(x[::2], x[1::2], 4)
    place = {int(v): i for i, v in enumerate(x)}
    even, odd_ = np.arange(0, len(x), 2), np.arange(1, len(x), 2)
    want = [(i, j) for i in even for j in odd_ if far[i, j] <= 4]
    assert components(len(x), [(place[int(p)], place[int(s)]) for p, s in zip(a, b)]) == components(len(x), want)
    ranks = simhash.gray_rank(np.array([i ^ (i >> 1) for i in range(256)], np.uint64))
    assert ranks.tolist() == list(range(256))


def test_simhash_chunks_of_a_frequent_share(spark, monkeypatch):
    rng = np.random.default_rng(6)
    codes = np.unique(np.concatenate([rng.integers(0, 2**40, 600), rng.integers(0, 2**40, 30) << 20])).astype(np.int64)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    df = spark.createDataFrame([(int(c),) for c in codes], "code long")
    found = [(r["a"], r["b"]) for r in simhash.linked(df).collect()]
    place = {int(c): i for i, c in enumerate(codes)}
    far = np.bitwise_count(codes[:, None] ^ codes[None, :])
    want = [(i, j) for i, j in zip(*np.nonzero(far <= 4)) if i < j]
    assert components(len(codes), [(place[a], place[b]) for a, b in found]) == components(len(codes), want)


# Language ----------------------------------------------------------------------------------------


def test_language(spark, odd, nothing):
    import random

    rng = random.Random(9)
    pools = {"aa": "abcde", "bb": "fghij", "cc": "éüñöa"}
    docs = []
    for i in range(200):
        lang = rng.choice(list(pools))
        text = " ".join("".join(rng.choice(pools[lang]) for _ in range(rng.randint(2, 6))) for _ in range(30))
        docs.append((i, text, lang))
    docs += [(200, None, "aa"), (201, "12 34 !!", "bb"), (None, "fgh ij", None), (202, "abcde " * 300_000, "aa"), (202, "", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.train(df)
    found = language.identify(df.withColumn("score", F.lit("x")), model).collect()
    held = [r for r in found if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["lang"]]
    assert held and all(r["lang_pred"] == r["lang"] for r in held if r["text"] and r["doc_id"] < 200)
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in found if not re.search(r"[^\W\d_]", r["text"] or ""))
    assert all(0 <= r["score"] <= 1 for r in found)
    assert language.train(nothing) is None
    assert language.identify(nothing, None).count() == 0
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    docs = [(i, f"{chr(0x4E00 + i % 230) * 4} {chr(0x6000 + i % 230) * 3}", f"l{i % 230}") for i in range(230 * 12)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    known = {lang for i, _, lang in docs if zlib.crc32(str(i).encode()) % 5}
    model = language.train(df)
    assert len(known) == 230 and set(model.languages) == known
    assert all(r["lang_pred"] == r["lang"] for r in language.identify(df.limit(230), model).collect())
    monkeypatch.setattr(language, "TRAIN_TOTAL", 229)
    with pytest.raises(ValueError):
        language.train(df)


# All stages --------------------------------------------------------------------------------------


def test_pipeline_stages_on_odd_rows(spark, odd, nothing, alike, tmp_path):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for number, docs in enumerate((odd, nothing, alike)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            out.write.parquet(str(tmp_path / f"{number}-{name}"))
            out = spark.read.parquet(str(tmp_path / f"{number}-{name}"))
            if name != "tokens":
                assert out.columns == docs.columns
                docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mix", "tokens"]


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_lines(docs):
    """Of every group of lines alike or similar, only the first stays; docs are (doc_id, text, source) in order of their ids."""
    found = [(i, n, line) for i, (_, text, _) in enumerate(docs) for n, line in enumerate(text.split("\n"))]
    words_of = [re.sub(r"[\W_]+", " ", line.lower()).split() for *_, line in found]
    pairs = []
    for a, b in combinations([k for k, w in enumerate(words_of) if w], 2):
        x, y = words_of[a], words_of[b]
        most = 0.2 * max(len(x), len(y)) + 1e-9
        if abs(len(x) - len(y)) <= most and plain_edits(x, y) <= most:
            pairs.append((a, b))
    gone = {found[k][:2] for k, root in enumerate(components(len(found), pairs)) if root != k}
    return [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in gone), s) for k, (i, t, s) in enumerate(docs)]


def plain_copies(docs):
    """How often the mix takes each document."""

    def chain(*values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True), h)
        return h - (1 << 64) if h >> 63 else h

    names = sorted({s for *_, s in docs})
    size = {d: len(WORD.findall(d[1])) for d in docs}
    total = [sum(size[d] for d in docs if d[2] == s) for s in names]
    copies = {}
    for s, t, wanted in zip(names, total, mixing.targets(total, [mixing.WEIGHTS[i % 3] for i in range(len(names))])):
        passes, salt = int(wanted // t), chain("blocks", s)
        step, shift = 2 * (salt % 512) + 1, (salt >> 20) % 1024
        placed = {}
        for d in docs:
            if d[2] == s:
                h = chain("mix", d[0], d[1])
                placed.setdefault((((h % (1 << 64)) >> 40) % 1024 * step + shift) % 1024, []).append((h, d))
        rest, open_ = wanted - passes * t, True
        for place in sorted(placed):
            words = sum(size[d] for _, d in placed[place])
            upto = 0
            for _, d in sorted(placed[place]):
                upto += size[d]
                copies[d] = passes + (open_ and (words <= rest or upto - size[d] / 2 <= rest))
            open_ = open_ and words <= rest
            rest -= words
    return copies


def test_pipeline_against_plain_python(spark, tmp_path):
    """Rows, texts, copies and ids of a whole run. No labels: every line then counts as content."""
    import tiktoken

    rng = np.random.default_rng(11)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdeinorst"), rng.integers(2, 8))) for _ in range(n))

    docs = []
    for i in range(24):
        notice = f"this page was last changed on day {i} by one of its many readers and editors"
        docs.append((i, f"{prose(40)}\n{prose(30)}.\n{notice}\n***", f"s{i % 3}"))
    for i in range(24, 36):
        words = docs[i - 24][1].split(" ")
        words[3 * i % 40] = "changed"
        docs.append((i, " ".join(words), f"s{i % 3}"))  # its lines are similar to others
    text = prose(400).split(" ")
    docs += [(36, "\n".join(" ".join(text[k : k + 50]) for k in range(0, 400, 50)), "s0")]
    docs += [(37, "\n".join(" ".join(text[:20] + text[20:][k : k + 37]) for k in range(0, 380, 37)), "s1")]  # other lines, alike as a whole
    docs += [(38, "too short", "s1"), (39, "again and again " * 30, "s2"), (40, docs[5][1], "s2")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    clean = [d for d in docs if not brute_counts(d[1])[-1]]
    assert 2 <= len(docs) - len(clean) <= 5
    lined = plain_lines(clean)
    assert lined != clean
    codes = [brute_code(t) for _, t, _ in lined]
    near = [(a, b) for a, b in combinations(range(len(lined)), 2) if (codes[a] ^ codes[b]).bit_count() <= simhash.DISTANCE]
    kept = [d for k, d in enumerate(lined) if components(len(lined), near)[k] == k]
    assert len(kept) < len(lined)
    copies = plain_copies(kept)
    assert len(set(copies.values())) > 1
    ranks, pattern = byte_bpe.public_ranks()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(ranks), special_tokens={})
    want = []
    for d, n in copies.items():
        ids = library.encode_ordinary(d[1])
        want += [(d[0], len(ids), ids, d[1])] * n
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_line_fingerprints_of_short_and_long_lines(spark):
    """Majority of the bits of the different words' hashes, also beyond the words that are counted together."""
    sizes = [1, 2, 3, 126, 127, 128, 254, 255, 400, 1000]
    texts = ["\n".join(" ".join(f"w{n}x{i}" for i in range(n)) + " w" for n in sizes)] * 3
    rows = line_dedup.occurrences(spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")).collect()
    assert len(rows) == 3 * len(sizes)
    lines = texts[0].split("\n")
    for r in rows:
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in set(lines[r["line"]].split())]
        expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert r["code"] & (2**64 - 1) == expected


def test_lines_that_repeat_a_few_words_are_told_apart(spark):
    """Words that come an even number of times leave no parity; counters tell such lines apart, and part none that are similar."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeinorst") for _ in range(6))
    bases = [[word() for _ in range(15)] * k for k in (6, 6, 6, 10, 10, 10, 32, 32)]

    def edited(words):
        out, left = list(words), len(words) // 5
        for _ in range(rng.randrange(left)):
            at, kind = rng.randrange(len(out)), rng.randrange(3)
            out[at : at + (kind > 0)] = [word()] if kind < 2 else []
        return out

    lines = [" ".join(x) for b in bases for x in (b, *(edited(b) for _ in range(6)))]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    codes = line_dedup.marked(docs).select("doc_id", "code")
    one, two = (codes.select(F.col("doc_id").alias(c), F.col("code").alias(f"code_{c}")) for c in "ab")
    told = [f("code_a", "code_b", line_dedup.SIMILARITY).alias(n) for f, n in ((line_dedup._possible, "possible"), (line_dedup._alike, "alike"))]
    both = one.join(two, F.col("a") < F.col("b")).select("a", "b", *told).collect()
    signs = spark.createDataFrame(list(enumerate(lines)), "id long, norm string").select("id", line_dedup.signs(F.col("norm")).alias("s"))
    x, y = signs.toDF("a", "x"), signs.toDF("b", "y")
    linked = {(r.a, r.b) for r in x.join(y, F.col("a") < F.col("b")).filter(line_dedup.similar(F.col("x"), F.col("y"))).collect()}
    assert linked and all(r.alike for r in both if (r.a, r.b) in linked)
    plain = [r for r in both if r.a % 7 == 0 and r.b % 7 == 0 and len(lines[r.a].split()) == len(lines[r.b].split())]
    assert len(plain) == 7 and all(r.possible for r in plain) and not any(r.alike for r in plain)


def test_groups_grow_as_edges_come(spark):
    """Components of edges that come in two parts are those of all edges."""
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    frame = lambda some: spark.createDataFrame(some, "a long, b long")
    first = line_dedup._joined(None, frame(edges[:140]))
    both, whole = line_dedup._joined(first, frame(edges[140:])), connected(frame(edges))
    groups = lambda found: sorted(sorted(r[1]) for r in found.groupBy("root").agg(F.collect_set("node")).collect())
    assert groups(both) == groups(whole) and both.count() == whole.count()
