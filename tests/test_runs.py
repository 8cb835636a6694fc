import pytest
from pyspark.sql import functions as F

from fieldgrant import DATASETS, Ledger, run_bronze, run_catalog, run_registry, run_silver
from fieldgrant.plans import ledger as ledgers
from fieldgrant.sources import sinks
from fieldgrant.streaming.ingest import ingest_available, landed_stream

HEADER = "Beneficiario;Municipio;Medida;FEAGA;FEADER;ImporteCofin\n"
SPAIN = DATASETS["SPAIN_2024"]


def land(root, text, name="a.csv", dataset="SPAIN/2024_LANDING"):
    folder = root / "landing" / dataset
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes((HEADER + text).encode("iso-8859-1"))


@pytest.fixture
def lake(spark, tmp_path):
    class Lake:
        landing, bronze, silver = (str(tmp_path / n) for n in ("landing", "bronze", "silver"))
        ledger = Ledger(spark, str(tmp_path / "ledger"))

        def run_bronze(self, **options):
            return run_bronze(spark, self.landing, self.bronze, self.ledger, "SPAIN", "2024", **options)

        def run_silver(self):
            return run_silver(spark, self.bronze, self.silver, self.ledger, SPAIN)

    return Lake()


def test_rerun_does_nothing_until_files_change(spark, tmp_path, lake):
    land(tmp_path, "Ana;Ávila;I.1;1,5;2;\n")
    assert [lake.run_bronze().status, lake.run_silver().status] == ["processed", "processed"]
    assert [lake.run_bronze().status, lake.run_silver().status] == ["skipped", "skipped"]
    land(tmp_path, "Eva;;II.1;1.234,5;;3\n", "b.csv")
    assert [lake.run_bronze().status, lake.run_silver().status] == ["processed", "processed"]
    got = sinks.read_silver(spark, lake.silver).orderBy("beneficiary").drop("silver_created_at").collect()
    assert [tuple(r) for r in got] == [
        ("Ana", "Ávila", "SPAIN", "2024", "I.1", 1.5, 2.0, 0.0),
        ("Eva", "UNKNOWN", "SPAIN", "2024", "II.1", 0.0, 0.0, 3.0),
    ]
    record = lake.ledger.record("SILVER", "spain", "2024").first()
    assert record.status == "processed" and record.created_at < record.updated_at
    assert record.metadata["rows"] == "2" and record.metadata["missing_municipality"] == "1"
    assert record.metadata["unparsed_total_eagf_income_support"] == "1"
    assert record.metadata["unparsed_total_eafrd_income_support"] == "0"


def test_broken_rule_commits_nothing_and_is_recorded(spark, tmp_path, lake):
    land(tmp_path, "Ana;Ávila;I.1;1,5;2;\n")
    lake.run_bronze(), lake.run_silver()
    land(tmp_path, "Eva;x;I.1;Infinity;2;\n", "b.csv")
    lake.run_bronze()
    outcome = lake.run_silver()
    assert (outcome.status, outcome.reason) == ("failed", "quality rule broken: finite total_eagf_income_support")
    assert [r.beneficiary for r in sinks.read_silver(spark, lake.silver).collect()] == ["Ana"]
    record = lake.ledger.record("SILVER", "SPAIN", "2024").first()
    assert (record.status, record.reason) == ("failed", outcome.reason)
    assert record.metadata["error_type"] == "QualityViolation"


def test_empty_and_missing_input(tmp_path, lake):
    assert lake.run_bronze().status == "empty"
    land(tmp_path, "", "a.pdf")
    assert lake.run_bronze().status == "empty"
    assert lake.ledger.events().isEmpty()
    land(tmp_path, "")
    assert lake.run_bronze().status == "processed"
    assert lake.run_silver().status == "failed"


def test_failed_bronze_is_reported_not_raised(tmp_path, lake):
    land(tmp_path, "Ana;Ávila;I.1;1,5;2;\n")
    assert lake.run_bronze(encoding="no-such-charset").status == "failed"
    assert lake.ledger.record("BRONZE", "SPAIN", "2024").first().status == "failed"
    assert lake.run_bronze().status == "processed"


def test_catalog_and_registry_runs_isolate_failures(spark, tmp_path, lake):
    land(tmp_path, "Ana;Ávila;I.1;1,5;2;\n")
    sources = spark.createDataFrame(
        [("SPAIN", "zip_csv", "2024", ";", "ISO-8859-1"), ("FRANCE", "scraper", "2024", None, None)],
        "country string, engine string, year string, delimiter string, encoding string",
    )
    outcomes = list(run_catalog(spark, sources, lake.landing, lake.bronze, lake.ledger))
    assert [(o.dataset_id, o.status) for o in outcomes] == [("SPAIN_2024", "processed")]
    specs = [DATASETS["GERMANY_2024"], SPAIN]
    outcomes = list(run_registry(spark, lake.bronze, lake.silver, lake.ledger, specs))
    assert [o.status for o in outcomes] == ["failed", "processed"]


def test_ledger(spark, lake):
    ledger = lake.ledger
    assert ledger.current().isEmpty() and not ledger.is_processed("BRONZE", "SPAIN", "2023")
    ledger.mark_failed("bronze", "spain", "2023", "no disk", metadata={"n": 1})
    ledger.mark_processed("BRONZE", "SPAIN", "2023")
    ledger.mark_processed("SILVER", "SPAIN", "2023", "f1")
    record = ledger.record("BRONZE", "SPAIN", "2023").first()
    assert (record.status, record.reason, record.country, record.year) == ("processed", None, "SPAIN", "2023")
    assert ledger.is_processed("BRONZE", "SPAIN", "2023") and not ledger.is_processed("BRONZE", "SPAIN", "2023", "f1")
    assert ledger.is_processed("SILVER", "SPAIN", "2023", "f1") and not ledger.is_processed("SILVER", "SPAIN", "2023")
    assert ledger.events().count() == 3 and ledger.current("BRONZE").count() == 1
    wanted = spark.createDataFrame([("SPAIN_2023", "f1"), ("SPAIN_2023", "f2"), ("X_1", None)],
                                   "dataset_id string, fingerprint string")
    assert sorted(tuple(r) for r in ledger.pending(wanted, "SILVER").collect()) == [("SPAIN_2023", "f2"), ("X_1", None)]


def test_pending_treats_null_fingerprints_as_equal(spark):
    wanted = spark.createDataFrame([("a", None), ("b", None), ("c", "1")], "k string, fingerprint string")
    done = spark.createDataFrame([("a", None), ("b", "1"), ("c", "1")], "k string, fingerprint string")
    assert [r.k for r in ledgers.pending(wanted, done, ["k"]).collect()] == ["b"]


def test_stream_ingests_each_file_once(spark, tmp_path):
    header = HEADER.strip().split(";")
    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    ledger = Ledger(spark, str(tmp_path / "ledger"))

    def run():
        rows = landed_stream(spark, landing, header, "SPAIN", "2024")
        ingest_available(rows, bronze, checkpoint, ledger, "SPAIN", "2024").awaitTermination()
        names = ["beneficiario", "municipio", "medida", "feaga", "feader", "importecofin"]
        return sinks.read_bronze(spark, bronze, names)

    land(tmp_path, "Ana;Ávila;I.1;1,5;2;\n")
    assert run().count() == 1
    land(tmp_path, "Eva;;II.1;1;;3\n", "b.csv")
    assert sorted(r.beneficiario for r in run().collect()) == ["Ana", "Eva"]
    assert run().count() == 2
    assert {(r.source_country, r.source_year) for r in run().select(F.col("source_country"), "source_year").collect()} == {
        ("SPAIN", "2024")
    }


def test_silver_follows_the_latest_processed_bronze(tmp_path, lake):
    land(tmp_path, "Ana;x;I.1;1;2;\n")
    assert [lake.run_bronze().status, lake.run_silver().status] == ["processed", "processed"]
    land(tmp_path, "Eva;x;I.1;1;2;\n", "b.csv")
    assert lake.run_bronze(encoding="no-such-charset").status == "failed"
    assert lake.run_silver().status == "skipped"
    assert [lake.run_bronze().status, lake.run_silver().status] == ["processed", "processed"]
    assert lake.ledger.record("SILVER", "SPAIN", "2024").first().metadata["rows"] == "2"


def test_relanding_without_rows_empties_bronze(spark, tmp_path, lake):
    land(tmp_path, "Ana;x;I.1;1;2;\n")
    lake.run_bronze(), lake.run_silver()
    land(tmp_path, "")
    assert lake.run_bronze().status == "processed"
    assert sinks.read_bronze_dataset(spark, lake.bronze, "SPAIN", "2024").isEmpty()
    outcome = lake.run_silver()
    assert (outcome.status, outcome.reason) == ("failed", "not_empty")


def test_compressed_files_are_read_and_others_named(spark, tmp_path, lake):
    import gzip

    land(tmp_path, "Ana;x;I.1;1;2;\n")
    folder = tmp_path / "landing/SPAIN/2024_LANDING"
    (folder / "b.csv.gz").write_bytes(gzip.compress((HEADER + "Eva;x;I.1;1;2;\n").encode()))
    (folder / "c.xlsx").write_bytes(b"x")
    outcome = lake.run_bronze()
    assert (outcome.status, outcome.reason) == ("processed", "not scannable: c.xlsx")
    assert sinks.read_bronze_dataset(spark, lake.bronze, "SPAIN", "2024").count() == 2
    metadata = lake.ledger.record("BRONZE", "SPAIN", "2024").first().metadata
    assert (metadata["files"], metadata["unread"]) == ("2", "c.xlsx")


def test_json_lines_documents_and_broken_ones(spark, tmp_path, lake):
    folder = tmp_path / "landing/SPAIN/2024_LANDING"
    folder.mkdir(parents=True)
    row = '{"beneficiario": "%s", "medida": "I.1"}'
    (folder / "a.json").write_text("\n".join(row % i for i in range(100)))
    (folder / "b.json").write_text("[\n" + ",\n".join(row.replace(", ", ",\n ") % f"}} {{ {i}" for i in range(5)) + "\n]")
    assert lake.run_bronze().status == "processed"
    assert sinks.read_bronze_dataset(spark, lake.bronze, "SPAIN", "2024").count() == 105
    (folder / "c.json").write_text('{"beneficiario":\n "x"} {"beneficiario": "y"} {"beneficiario":\n "z"}')
    assert lake.run_bronze().status == "processed"
    assert sinks.read_bronze_dataset(spark, lake.bronze, "SPAIN", "2024").count() == 108


def test_number_of_jobs_does_not_follow_the_files(spark, tmp_path):
    from fieldgrant.sources import readers

    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.csv").write_text(("x;y\n" if i % 2 else "y;x\n") + "1;2\n")
        spark.sparkContext.setJobGroup(f"files-{n}", "count jobs")
        df = readers.read_landed(spark, [str(folder / f"{i}.csv") for i in range(n)])
        assert df.count() == n and df.filter("x = '1'").count() == n // 2
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files-{n}"))

    assert jobs(80) == jobs(160)  # Spark lists more than 32 paths in a job of its own


def test_stream_then_silver_then_batch(spark, tmp_path, lake):
    header = HEADER.strip().split(";")

    def stream(checkpoint="c"):
        rows = landed_stream(spark, lake.landing, header, "SPAIN", "2024")
        return ingest_available(rows, lake.bronze, str(tmp_path / checkpoint), lake.ledger, "SPAIN", "2024")

    def names():
        return sorted(r.beneficiario for r in sinks.read_bronze_dataset(spark, lake.bronze, "SPAIN", "2024").collect())

    land(tmp_path, "Ana;x;I.1;1;2;\n")
    stream().awaitTermination()
    assert lake.run_silver().status == "processed" and lake.run_silver().status == "skipped"
    land(tmp_path, "Eva;x;I.1;1;2;\n", "b.csv")
    stream().awaitTermination()
    assert lake.run_silver().status == "processed" and names() == ["Ana", "Eva"]
    land(tmp_path, "Ida;x;I.1;1;2;\n", "c.csv")
    assert lake.run_bronze().status == "processed" and names() == ["Ana", "Eva", "Ida"]
    with pytest.raises(Exception, match="new checkpoint"):
        stream().awaitTermination()
    stream("d").awaitTermination()
    assert names() == ["Ana", "Eva", "Ida"] and lake.run_silver().status == "processed"


def test_extra_columns_repair_and_grain(spark, tmp_path, lake):
    from fieldgrant.spec import FieldSpec

    land(tmp_path, "Ana;x;I.1;1;2;\nAna;x;I.1;1;2;\n")
    lake.run_bronze()
    wide = SPAIN.with_fields(FieldSpec("province", "municipio"))
    assert run_silver(spark, lake.bronze, lake.silver, lake.ledger, wide, unique_grain=True).status == "failed"
    assert run_silver(spark, lake.bronze, lake.silver, lake.ledger, wide).status == "processed"
    assert lake.ledger.record("SILVER", "SPAIN", "2024").first().metadata["repeated_grain"] == "1"
    assert spark.read.parquet(lake.silver).first().province == "x"
    irish = DATASETS["IRELAND_2023"]
    names = [f.source for f in irish.fields if not f.source.startswith("source_")]
    columns = [*names, "end_date_³", "source_country", "source_year"]
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.createDataFrame([("a", "m", "c", None, "0", "0", "12.5", "IRELAND", "2023")], schema)
    assert rows.transform(irish.prepare).first()[names[3]] == "12.5"
    assert rows.drop("end_date_³").transform(irish.prepare).columns == [c for c in columns if c != "end_date_³"]


def test_ledger_compaction_keeps_the_events(spark, lake):
    for i in range(3):
        lake.ledger.mark_processed("BRONZE", "X", "1", f"f{i}")
    before = sorted(map(str, lake.ledger.events().collect()))
    lake.ledger.compact()
    assert sorted(map(str, lake.ledger.events().collect())) == before
    assert lake.ledger.latest_processed("BRONZE", "X", "1") == "f2"


def test_headers_that_disagree_are_an_error(spark):
    from fieldgrant.operators.shape import promote_header

    rows = spark.createDataFrame([("name", "a", "b"), ("name", "b", "a"), ("x", "1", "2")], "c0 string, c1 string, c2 string")
    with pytest.raises(ValueError, match="different columns"):
        promote_header(rows, "name")
