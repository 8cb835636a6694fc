"""JSON files of any shape reach bronze in full."""

import json
import random
from collections import Counter

import pytest

from fieldgrant.plans.bronze import run_bronze
from fieldgrant.plans.ledger import Ledger
from fieldgrant.sources import json_scan
from fieldgrant.sources.json_scan import as_lines
from fieldgrant.sources.readers import read_files, read_landed
from fieldgrant.sources.sinks import read_bronze_dataset

TRICKY = ['a "quoted" {brace', "]}[{", "back\\slash\\", 'end\\"', "", "\t", "é漢😀", "{\"a\": 1}", "x" * 20_000, '\\"' * 3_000]


@pytest.fixture
def landed(spark, tmp_path):
    """What a run makes of files given as texts: (status, reason, rows, metadata)."""

    def run(**files):
        folder = tmp_path / "landing" / "SPAIN" / "2023_LANDING"
        folder.mkdir(parents=True)
        for name, text in files.items():
            (folder / f"{name}.json").write_bytes(text.encode() if isinstance(text, str) else text)
        ledger = Ledger(spark, str(tmp_path / "ledger"))
        done = run_bronze(spark, str(tmp_path / "landing"), str(tmp_path / "bronze"), ledger, "SPAIN", "2023")
        if done.status != "processed":
            return done.status, done.reason, [], {}
        rows = read_bronze_dataset(spark, str(tmp_path / "bronze"), "SPAIN", "2023").collect()
        return done.status, done.reason, rows, ledger.current().first().metadata

    return run


def test_two_indented_documents_in_a_file(landed):
    text = "\n".join(json.dumps({"a": i, "b": {"c": [i]}}, indent=2) for i in (1, 2))
    status, reason, rows, _ = landed(x=text)
    assert (status, reason) == ("processed", None)
    assert sorted((r.a, r.b) for r in rows) == [("1", '{"c":[1]}'), ("2", '{"c":[2]}')]


@pytest.mark.parametrize("bad", ["oops", '{"a": 1, "b', '{"a": ', "{", '"', "]", '{"a": 1}}', "5", '{"a": 1}, {"a": 2}', '{"a": 1}],[{"a": 2}'])
def test_a_bad_line_costs_no_other(landed, bad):
    """First, amid or last of a file's lines."""
    lines = [json.dumps({"a": i, "b": "x"}) for i in range(100)]
    status, reason, rows, metadata = landed(**{f"f{at}": "\n".join(lines[:at] + [bad] + lines[at:]) for at in (0, 40, 100)})
    assert status == "processed" and set(rows[0].asDict()) >= {"a", "b"}
    got = sorted(int(r.a) for r in rows if r.b == "x")
    assert got == sorted([*range(100)] * 3)
    if bad == '{"a": 1}, {"a": 2}':  # two good records on a line
        assert len(rows) == 306 and "broken" not in metadata
    else:
        assert metadata["broken"] in ("3", "6") and "broken" in reason and len(rows) == 300


def test_a_broken_object_among_documents(landed):
    texts = [json.dumps({"a": i}, indent=1) for i in range(5)]
    texts[2] = '{\n "a" 2\n}'
    _, _, rows, metadata = landed(x="\n".join(texts))
    assert sorted(r.a for r in rows) == ["0", "1", "3", "4"] and metadata["broken"] == "1"


def test_only_broken_text_fails(landed):
    status, reason, rows, _ = landed(x="oops\nand again")
    assert status == "failed" and reason


def records(rng, n):
    return [{"id": i, "text": rng.choice(TRICKY), "more": {"list": [rng.choice(TRICKY), {"deep": [[]]}], "n": None}} for i in range(n)]


def shapes(rows, rng):
    """The same rows written in many ways."""
    dump = json.dumps
    return {
        "lines": "\n".join(map(dump, rows)),
        "crlf": "\r\n".join(dump(r, ensure_ascii=False) for r in rows),
        "indented": "\n".join(dump(r, indent=rng.choice([1, 4])) for r in rows),
        "array": dump(rows, indent=2),
        "flat_array": dump(rows),
        "array_by_line": "[\n" + ",\n".join(map(dump, rows)) + "\n]",
        "arrays": dump(rows[: len(rows) // 2], indent=1) + "\n" + dump(rows[len(rows) // 2 :], indent=1),
        "joined": "".join(map(dump, rows)),
        "joined_indented": " ".join(dump(r, indent=3) for r in rows),
        "blank_lines": "\n\n" + "\n \n\t\n".join(dump(r, indent=2) for r in rows) + "\n\n",
        "all_apart": dump(rows, indent=0, separators=("\n,\n", "\n:\n")),
    }


@pytest.mark.parametrize("split", ["128m", "1k"])
def test_every_shape(spark, tmp_path, split):
    """Whatever the shape, and wherever Spark splits a file."""
    rng = random.Random(3)
    rows = records(rng, 30)
    texts = shapes(rows, rng)
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = read_files(spark, str(tmp_path), ".json")
        assert sorted(got.columns) == ["id", "more", "text"]
        found = Counter((r.id, r.text, r.more.list[0], str(json.loads(r.more.list[1]))) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == Counter({(r["id"], r["text"], r["more"]["list"][0], "{'deep': [[]]}"): len(texts) for r in rows})


def test_shapes_together(spark, tmp_path):
    rng = random.Random(4)
    texts = shapes(records(rng, 6), rng)
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8", newline="")
    (tmp_path / "empty.json").write_text(" \n")
    (tmp_path / "rows.csv").write_text("id;text\n100;x\n")
    files = [str(p) for p in tmp_path.iterdir()]
    rows = read_landed(spark, files, ";").collect()
    assert sorted(int(r.id) for r in rows) == sorted([*range(6)] * len(texts) + [100])


def test_records_of_one_array_are_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "large.json"
    path.write_text(json.dumps([{"id": i, "text": "x" * 50} for i in range(2_000)], indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        (out,) = as_lines(spark, [str(path)])
        assert spark.read.json(out).count() == 2_000
        assert spark.read.text(out).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scratch_holds_records_not_lines(spark, tmp_path, monkeypatch):
    """What is kept between the steps grows with records and blocks; a row per line made long runs of it."""
    path = tmp_path / "large.json"
    path.write_text("\n".join(json.dumps({"id": i, "list": list(range(20))}, indent=2) for i in range(100)))
    held, kept = [], json_scan.materialise
    monkeypatch.setattr(json_scan, "materialise", lambda df, *args: held.append(kept(df, *args)) or held[-1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        (out,) = as_lines(spark, [str(path)])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.id for r in spark.read.json(out).collect()) == list(range(100))
    assert held and all(t.count() < 200 for t in held)


@pytest.mark.parametrize("split", ["128m", "16"])
def test_text_between_records_of_an_array(spark, tmp_path, split):
    """A list among records is told; before, it was taken for the end of the record ahead of it and lost."""
    (tmp_path / "x.json").write_text('[{"a":\n1},\n[7,\n8, 9],\n{"a": 2}, "s[{", {"a":\n{"a": 3}}]\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        (out,) = as_lines(spark, [str(tmp_path / "x.json")])
        lines = [r.value for r in spark.read.text(out).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    records = [json.loads(v)["a"] for v in lines if v.startswith("{")]
    assert sorted(map(str, records)) == ["1", "2", "{'a': 3}"]
    others = "".join(v for v in lines if not v.startswith("{"))
    assert all(c in others for c in ("7", "8", "9", '"s[{"'))


def test_scratch_holds_records_once(spark, tmp_path, monkeypatch):
    """Records were kept as cut and again as lines, uncompressed; with many blocks, so that some records are parted by their edges."""
    path = tmp_path / "large.json"
    path.write_text("\n".join(json.dumps({"id": i, "text": "some words " * 40}, indent=2) for i in range(1_000)))
    monkeypatch.setattr(json_scan, "scratch_path", lambda _, name: str(tmp_path / "scratch" / name))
    monkeypatch.setattr(json_scan, "materialise", lambda df, *_: df.cache())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        (out,) = as_lines(spark, [str(path)])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.id for r in spark.read.json(out).collect()) == list(range(1_000))
    held = [p for p in (tmp_path / "scratch").rglob("*") if p.is_file()]
    assert sum(p.stat().st_size for p in held) < path.stat().st_size / 2
    spark.catalog.clearCache()


def test_files_without_records_give_none(spark, tmp_path):
    """Brackets alone, so that nothing is written as the file is cut."""
    (tmp_path / "x.json").write_text("[\n\n]\n")
    assert [spark.read.text(p).count() for p in as_lines(spark, [str(tmp_path / "x.json")])] == [0]
