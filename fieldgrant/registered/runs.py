"""Whole runs from landed files, batch and incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.bronze import RunOutcome, run_bronze
from ..plans.ledger import Ledger
from ..plans.master import build_master
from ..plans.silver import run_silver
from ..sources import sinks
from ..sources.scratch import materialise, scratch_path
from ..streaming.ingest import ingest_available, landed_stream
from . import fixtures, payouts
from .fixtures import LABELLED_BRONZE_SQL, silver_sql

COLUMNS = ("beneficiario", "municipio", "medida", "feaga", "feader", "importecofin")
# The landed header of the second file set lacks one column and orders the rest differently.
DRIFTED = ("Importe-Cofin", "Medida", "Feaga", "Beneficiario", "Feader")


def _landable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze fixture with published labels, computed once for queries that land it in parts."""
    return materialise(fixtures.bronze(spark, sf_dir, labels=True), "landable")


def _land(spark: SparkSession, sf_dir: str, root: str, drift: bool) -> None:
    """Write the bronze fixture as delimited files of SPAIN 2023; with ``drift`` the rows of odd
    years come in files with another header."""
    rows = _landable(spark, sf_dir) if drift else fixtures.bronze(spark, sf_dir, labels=True)
    odd = F.col("source_year").cast("int") % 2 == 1
    folder = f"{root}/SPAIN/2023_LANDING"
    plain = rows.filter(~odd) if drift else rows
    plain.select(*COLUMNS).toDF(*[c.upper() for c in COLUMNS]).write.csv(
        f"{folder}/plain", header=True, sep=";", encoding="ISO-8859-1"
    )
    if drift:
        rows.filter(odd).select("importecofin", "medida", "feaga", "beneficiario", "feader").toDF(*DRIFTED).write.csv(
            f"{folder}/drifted", header=True, sep=";", encoding="ISO-8859-1"
        )


def _done(outcome: RunOutcome) -> None:
    if outcome.status != "processed":
        raise RuntimeError(f"{outcome.dataset_id} {outcome.status}: {outcome.reason}")


def _bronze(spark: SparkSession, sf_dir: str, drift: bool) -> tuple[str, Ledger]:
    root = scratch_path(spark, "run")
    _land(spark, sf_dir, f"{root}/landing", drift)
    ledger = Ledger(spark, f"{root}/ledger")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023", ";", "ISO-88591"))
    return root, ledger


def bronze_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _bronze(spark, sf_dir, drift=True)
    return sinks.read_bronze(spark, f"{root}/bronze").drop("ingested_at")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, ledger = _bronze(spark, sf_dir, drift=False)
    _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, fixtures.SPAIN))
    return sinks.read_silver(spark, f"{root}/silver")


def silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).drop("silver_created_at")


def master_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_master(_silver(spark, sf_dir))


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream")
    _land(spark, sf_dir, f"{root}/landing", drift=False)
    header = [c.upper() for c in COLUMNS]
    rows = landed_stream(spark, f"{root}/landing/SPAIN/2023_LANDING", header, "SPAIN", "2023", encoding="latin-1")
    ledger = Ledger(spark, f"{root}/ledger")
    ingest_available(rows, f"{root}/bronze", f"{root}/checkpoint", ledger, "SPAIN", "2023").awaitTermination()
    return sinks.read_bronze(spark, f"{root}/bronze", COLUMNS).drop("ingested_at")


def rerun_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after bronze took new files, failed, and was run again: the new rows are there."""
    root = scratch_path(spark, "run")
    rows = _landable(spark, sf_dir)
    odd = F.col("source_year").cast("int") % 2 == 1
    folder, ledger = f"{root}/landing/SPAIN/2023_LANDING", Ledger(spark, f"{root}/ledger")

    def land(part, name):
        part.select(*COLUMNS).write.csv(f"{folder}/{name}", header=True, sep=";", encoding="ISO-8859-1")

    def bronze(encoding):
        return run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023", ";", encoding)

    land(rows.filter(~odd), "first")
    _done(bronze("ISO-88591"))
    _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, fixtures.SPAIN))
    land(rows.filter(odd), "second")
    if bronze("no-such-charset").status != "failed":
        raise RuntimeError("a charset that doesn't exist was read")
    if run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, fixtures.SPAIN).status != "skipped":
        raise RuntimeError("silver ran again without new bronze rows")
    _done(bronze("ISO-88591"))
    _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, fixtures.SPAIN))
    return sinks.read_silver(spark, f"{root}/silver").drop("silver_created_at")


def stream_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver follows a stream: rows that a second ingest brings arrive too."""
    root = scratch_path(spark, "stream")
    rows = _landable(spark, sf_dir)
    odd = F.col("source_year").cast("int") % 2 == 1
    folder, ledger = f"{root}/landing/SPAIN/2023_LANDING", Ledger(spark, f"{root}/ledger")
    for name, part in (("first", rows.filter(~odd)), ("second", rows.filter(odd))):
        part.select(*COLUMNS).write.csv(f"{folder}/{name}", header=True, sep=";", encoding="ISO-8859-1")
        stream = landed_stream(spark, folder, list(COLUMNS), "SPAIN", "2023", encoding="latin-1")
        ingest_available(stream, f"{root}/bronze", f"{root}/checkpoint", ledger, "SPAIN", "2023").awaitTermination()
        _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, fixtures.SPAIN))
    return sinks.read_silver(spark, f"{root}/silver").drop("silver_created_at")


def stream_and_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream, then a batch run over all landed files, into one bronze dataset."""
    root = scratch_path(spark, "both")
    rows = _landable(spark, sf_dir)
    odd = F.col("source_year").cast("int") % 2 == 1
    folder, ledger = f"{root}/landing/SPAIN/2023_LANDING", Ledger(spark, f"{root}/ledger")
    rows.filter(~odd).select(*COLUMNS).write.csv(f"{folder}/first", header=True, sep=";", encoding="ISO-8859-1")
    stream = landed_stream(spark, folder, list(COLUMNS), "SPAIN", "2023", encoding="latin-1")
    ingest_available(stream, f"{root}/bronze", f"{root}/checkpoint", ledger, "SPAIN", "2023").awaitTermination()
    rows.filter(odd).select(*COLUMNS).write.csv(f"{folder}/second", header=True, sep=";", encoding="ISO-8859-1")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023", ";", "ISO-88591"))
    return sinks.read_bronze(spark, f"{root}/bronze", COLUMNS).drop("ingested_at")


def relanded_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a dataset was landed again with fewer rows, none where the year is odd."""
    root = scratch_path(spark, "run")
    ledger = Ledger(spark, f"{root}/ledger")
    rows = _landable(spark, sf_dir)
    odd = F.col("source_year").cast("int") % 2 == 1
    for turn, by_year in enumerate(({"2022": rows.filter(~odd), "2023": rows}, {"2023": rows.filter(odd).limit(0)})):
        for year, part in by_year.items():
            folder = f"{root}/landing-{turn}/SPAIN/{year}_LANDING/x"
            part.select(*COLUMNS).write.csv(folder, header=True, sep=";", encoding="ISO-8859-1")
            _done(run_bronze(spark, f"{root}/landing-{turn}", f"{root}/bronze", ledger, "SPAIN", year, ";", "ISO-88591"))
    return sinks.read_bronze(spark, f"{root}/bronze", COLUMNS).drop("ingested_at")


def bronze_run_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines reach bronze in full."""
    root = scratch_path(spark, "run")
    rows = fixtures.bronze(spark, sf_dir, labels=True).select(*COLUMNS, "source_year")
    odd = F.col("source_year").cast("int") % 2 == 1
    folder = f"{root}/landing/SPAIN/2023_LANDING"
    rows.select(F.when(odd, F.lit("odd")).otherwise("even").alias("part"), *COLUMNS).write.option(
        "ignoreNullFields", "false"
    ).partitionBy("part").json(folder)
    ledger = Ledger(spark, f"{root}/ledger")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023"))
    return sinks.read_bronze(spark, f"{root}/bronze", COLUMNS).drop("ingested_at")


def bronze_run_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "run")
    rows = fixtures.bronze(spark, sf_dir, labels=True).select(*COLUMNS)
    rows.write.csv(
        f"{root}/landing/SPAIN/2023_LANDING/x", header=True, sep=";", encoding="ISO-8859-1", compression="gzip"
    )
    ledger = Ledger(spark, f"{root}/ledger")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023", ";", "ISO-88591"))
    return sinks.read_bronze(spark, f"{root}/bronze", COLUMNS).drop("ingested_at")


QUERIES = {
    "rerun_after_failure": rerun_after_failure,
    "stream_to_silver": stream_to_silver,
    "stream_and_batch": stream_and_batch,
    "relanded_empty": relanded_empty,
    "bronze_run_json": bronze_run_json,
    "bronze_run_compressed": bronze_run_compressed,
    "bronze_run": bronze_run,
    "silver_run": silver_run,
    "master_run": master_run,
    "bronze_stream": bronze_stream,
}

_LANDED_SQL = f"""
SELECT beneficiario, municipio, medida, feaga, feader, importecofin, 'SPAIN' AS source_country, '2023' AS source_year
FROM ({LABELLED_BRONZE_SQL})"""

ORACLES = {
    "bronze_run": f"""
SELECT beneficiario, CASE WHEN y % 2 = 0 THEN municipio END AS municipio, medida, feaga, feader,
  CASE WHEN y % 2 = 0 THEN importecofin END AS importecofin, CASE WHEN y % 2 = 1 THEN importecofin END AS importe_cofin,
  'SPAIN' AS source_country, '2023' AS source_year
FROM (SELECT *, source_year::INTEGER AS y FROM ({LABELLED_BRONZE_SQL}))""",
    "silver_run": silver_sql(_LANDED_SQL),
    "rerun_after_failure": silver_sql(_LANDED_SQL),
    "stream_to_silver": silver_sql(_LANDED_SQL),
    "stream_and_batch": _LANDED_SQL,
    "relanded_empty": f"""
SELECT beneficiario, municipio, medida, feaga, feader, importecofin, 'SPAIN' AS source_country, '2022' AS source_year
FROM ({LABELLED_BRONZE_SQL}) WHERE source_year::INTEGER % 2 = 0""",
    "bronze_run_json": _LANDED_SQL,
    "bronze_run_compressed": _LANDED_SQL,
    "master_run": payouts.ORACLES["beneficiary_master"],
    "bronze_stream": _LANDED_SQL,
}
