import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, quality_report string"


def words(rng, n, alphabet="abcdeinorst"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty texts, repeated rows and ids, near copies, shared passages, long texts; two columns have names
    that operators use themselves."""
    rng = random.Random(7)
    passage = words(rng, 160)
    base = [words(rng, rng.randint(30, 200)) for _ in range(12)]
    rows = []

    def add(i, text, lang="en", source="s1"):
        rows.append((i, text, lang, source, None if text is None else len(text), "x", None))

    for i, t in enumerate(base):
        add(i, t + "\n" + words(rng, 20) + ".", "en" if i % 2 else "de", f"s{i % 3}")
    for i in range(12, 18):
        t = base[i - 12].split(" ")
        t[rng.randrange(len(t))] = "changed"
        add(i, " ".join(t), "en", None)
    add(18, None, None, None)
    add(19, "")
    add(20, " \n\t \n")
    add(21, base[0] + " " + passage)
    add(22, passage + " " + base[1])
    add(23, passage + passage)
    for _ in range(3):
        add(24, base[2])
    add(24, base[3])
    add(None, base[4], None)
    add(None, base[4], None)
    add(25, "a" * 3000)
    add(26, "é漢😀 " * 300)
    add(27, "<|endoftext|> 's  two   spaces\r\n x ")
    add(28, "\n".join([base[5]] * 40))
    add(29, words(rng, 30_000))
    add(-5, "one", "xx", "ß")
    add(2**62 + 1, "large id")
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def alike(spark):
    return spark.createDataFrame([(1, "same text here", "en", "s", 14, "x", None)] * 50, SCHEMA)
