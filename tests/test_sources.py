import pytest
from pyspark.sql import functions as F

from fieldgrant.catalog import SOURCES, active_sources, catalog
from fieldgrant.sources import landing, readers, scratch, sinks
from fieldgrant.spec import SILVER_SCHEMA


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_delimited_rules(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Größe;b;c\n1\n1;2;3;4\n"x;y"; pad ;"  "\n;;\n')
    df = readers.read_files(spark, path, ".CSV", delimiter=";")
    assert df.columns[0] == "GrÃ¶Ã\u009fe" and [t for _, t in df.dtypes] == ["string"] * 3
    assert [tuple(r) for r in df.collect()] == [
        ("1", None, None), ("1", "2", "3"), ("x;y", "pad", "  "), (None, None, None)
    ]
    assert readers.read_files(spark, path, ".txt", encoding="utf-8").columns[0] == "Größe"


def test_charset_labels():
    assert [readers.charset(c) for c in ("latin-1", "ISO-88591", "ISO-8859-1", "utf-8", None)] == [
        "ISO-8859-1", "ISO-8859-1", "ISO-8859-1", "UTF-8", "ISO-8859-1"
    ]


def test_json_documents_and_lines(spark, tmp_path):
    documents = write(tmp_path / "a.json", '[\n {"a": 1,\n  "b": {"c": "x"}},\n {"a": 2}\n]')
    assert rows(readers.read_files(spark, documents, ".json").select("a", "b.c")) == [(1, "x"), (2, None)]
    lines = write(tmp_path / "b.json", '{"a": 1}\n{"a": 2}\n')
    assert rows(readers.read_json(spark, lines, "a int", lines=True)) == [(1,), (2,)]


def test_unsupported_format(spark):
    with pytest.raises(ValueError, match="xlsx"):
        readers.read_files(spark, "a.xlsx", readers.file_suffix("dir/A.XLSX"))


def test_files_with_another_header_fail_when_declared_same(spark, tmp_path):
    write(tmp_path / "d/a.csv", "x;y\n1;2\n")
    write(tmp_path / "d/b.csv", "y;x\n1;2\n")
    files = [str(tmp_path / "d/a.csv"), str(tmp_path / "d/b.csv")]
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_landed(spark, files, same_header=True).collect()
    assert rows(readers.read_landed(spark, files).select("x", "y")) == [("1", "2"), ("2", "1")]


def test_landed_files_of_all_formats_unite(spark, tmp_path):
    write(tmp_path / "a.csv", "Key A;b\n1;2\n")
    write(tmp_path / "b.json", '[{"Key A": 3, "c": true}]')
    spark.createDataFrame([(4.5, "z")], "`key-a` double, d string").coalesce(1).write.parquet(str(tmp_path / "c"))
    parquet = next(str(p) for p in (tmp_path / "c").glob("*.parquet"))
    df = readers.read_landed(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.json"), parquet, "skip.pdf"])
    assert set(df.columns) == {"key_a", "b", "c", "d"}
    assert rows(df.select("key_a", "b", "c", "d")) == [
        ("1", "2", None, None), ("3", None, "true", None), ("4.5", None, None, "z")
    ]
    with pytest.raises(FileNotFoundError):
        readers.read_landed(spark, ["skip.pdf"])


def test_inventory_accepts_any_suffix(spark, tmp_path):
    for name in ("a.csv", "sub/B.CSV.gz", "c.xlsx", "d.pdf", "csv", "e.json.bak", "f.csvx"):
        write(tmp_path / name, "x")
    names = [r.file_name for r in landing.inventory(spark, str(tmp_path)).collect()]
    assert sorted(names) == ["B.CSV.gz", "a.csv", "c.xlsx", "e.json.bak"]


def test_landing_fingerprint_follows_the_files(spark, tmp_path):
    write(tmp_path / "a.csv", "x\n1\n")
    before = landing.landing_fingerprint(landing.inventory(spark, str(tmp_path))).first()
    again = landing.landing_fingerprint(landing.inventory(spark, str(tmp_path))).first()
    write(tmp_path / "b.csv", "x\n2\n")
    after = landing.landing_fingerprint(landing.inventory(spark, str(tmp_path))).first()
    assert before == again and (before.file_count, after.file_count) == (1, 2)
    assert before.fingerprint != after.fingerprint


def test_require_link(spark):
    pages = spark.createDataFrame([(1, "http://h/x", "<a href='/2024.xls'>")], "page_id int, url string, html string")
    assert landing.require_link(pages, "2024").first().link == "http://h/2024.xls"
    with pytest.raises(Exception, match="no link for 2023 on http://h/x"):
        landing.require_link(pages, "2023").collect()


def test_writing_replaces_only_the_partitions_at_hand(spark, tmp_path):
    path = str(tmp_path / "bronze")
    stamp = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    first = spark.createDataFrame([("a", "ES", "2023"), ("b", "ES", "2024")], "v string, source_country string, source_year string")
    sinks.write_bronze(first.withColumn("ingested_at", stamp), path)
    second = spark.createDataFrame([("c", "x", "ES", "2024")], "v string, w string, source_country string, source_year string")
    sinks.write_bronze(second.withColumn("ingested_at", stamp), path, rebalance=True)
    got = sinks.read_bronze(spark, path)
    assert dict(got.dtypes)["source_year"] == "string"
    assert rows(got.select("v", "w", "source_year")) == [("a", None, "2023"), ("c", "x", "2024")]
    assert rows(sinks.read_bronze(spark, path, ["v"]).select("v", "source_country")) == [("a", "ES"), ("c", "ES")]
    one = sinks.read_bronze_dataset(spark, path, "ES", "2023")
    assert rows(one.select("v", "source_country", "source_year")) == [("a", "ES", "2023")]


def test_silver_table_keeps_contract_order_and_types(spark, tmp_path):
    df = spark.createDataFrame([("b", "m", "ES", "2024", "I.1", 1.0, 2.0, 3.0, None)], SILVER_SCHEMA)
    sinks.write_silver(df, str(tmp_path / "silver"))
    assert sinks.read_silver(spark, str(tmp_path / "silver")).dtypes == df.dtypes


def test_range_round_trip(spark, tmp_path):
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "smoke"))
    assert rows(readers.read_files(spark, str(tmp_path / "smoke"), ".parquet")) == [(i,) for i in range(5)]


def test_catalog(spark):
    active = active_sources(catalog(spark))
    assert catalog(spark).count() == len(SOURCES) == 12
    assert sorted({r.country for r in active.collect()}) == ["GERMANY", "IRELAND", "SPAIN", "UK"]


def test_scratch_is_below_the_session_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = scratch.scratch_path(spark, "x")
    assert path.startswith(root) and path != scratch.scratch_path(spark, "x")
    df = spark.range(3).withColumn("t", F.lit("a"))
    assert rows(scratch.materialise(df, "kept")) == rows(df)


def test_large_files_are_digested_in_pieces(spark, tmp_path):
    """Files too large for one task get the digest of their pieces, with the same columns; the others keep their MD5."""
    import hashlib

    texts = {"small.csv": b"a;b\n", "large.csv": b"line\n" * 200 + b"\x00\xff end", "other.txt": b"x"}
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    found = landing.file_fingerprints(spark, str(tmp_path), whole=100)
    assert found.columns == ["path", "file_name", "length", "fingerprint"]
    told = {r.file_name: (r.length, r.fingerprint) for r in found.collect()}
    pieces = {r.file_name: r.fingerprint for r in landing.content_fingerprints(spark, str(tmp_path)).collect()}
    md5 = {n: hashlib.md5(d).hexdigest() for n, d in texts.items()}
    assert told == {n: (len(d), pieces[n] if n == "large.csv" else md5[n]) for n, d in texts.items()}
    whole = landing.file_fingerprints(spark, str(tmp_path))
    assert {r.file_name: r.fingerprint for r in whole.collect()} == md5
