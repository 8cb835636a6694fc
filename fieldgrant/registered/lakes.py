"""Runs over files of odd shapes, checks within runs, and tables kept between runs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.bronze import run_bronze
from ..plans.bucketed import bucketed_master, buckets_for, write_layout
from ..plans.incremental import MasterTable
from ..plans.ledger import Ledger
from ..plans.profiles import ProfileStore
from ..plans.silver import run_silver
from ..sources import landing, sinks
from ..sources.scratch import discard, materialise, release, scratch_path
from ..spec import DATASETS, SILVER_GRAIN, FieldSpec
from . import fixtures, payouts, shaping
from .fixtures import LABELLED_BRONZE_SQL, silver_sql, table
from .runs import _LANDED_SQL, COLUMNS, _bronze, _done, _landable

#: Rows of a landed array: a document's text is made by one task.
ROWS_PER_ARRAY = 10_000


def bronze_run_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indented documents, many in a file, and indented arrays of them, reach bronze in full."""
    root = scratch_path(spark, "run")
    folder = f"{root}/landing/SPAIN/2023_LANDING"
    rows = fixtures.bronze(spark, sf_dir, labels=True).select(*COLUMNS, F.col("source_year").cast("int").alias("year"))
    rows = rows.withColumn("value", F.to_json(F.struct(*COLUMNS), {"pretty": "true", "ignoreNullFields": "false"}))
    rows = materialise(rows.select("year", "value"), "landed", compression="zstd")
    release(spark)
    rows.filter("year % 2 = 0").select("value").write.text(f"{folder}/documents", compression="none")
    odd = rows.filter("year % 2 = 1")
    # The documents of a task in arrays of so many, line by line; the number of each task's last one tells where its last array ends.
    odd = odd.select(F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % (1 << 33)).alias("at"), "value")
    ends = odd.groupBy("part").agg(F.max("at").alias("last"))
    within = F.col("at") % ROWS_PER_ARRAY
    opens, closes = F.when(within == 0, "[\n").otherwise(""), F.when((within == ROWS_PER_ARRAY - 1) | (F.col("at") == F.col("last")), "\n]").otherwise(",")
    odd.join(F.broadcast(ends), "part").select(F.concat(opens, "value", closes).alias("value")).write.text(f"{folder}/arrays")
    discard(rows)
    release(spark)
    # Text files are landed as JSON files are named.
    ledger = Ledger(spark, f"{root}/ledger")
    _rename_json(spark, folder)
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023"))
    return sinks.read_bronze(spark, f"{root}/bronze", COLUMNS).drop("ingested_at")


def _rename_json(spark: SparkSession, folder: str) -> None:
    """Give landed text files the suffix of JSON files."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    store = root.getFileSystem(conf)
    files = store.listFiles(root, True)
    found = []
    while files.hasNext():
        found.append(files.next().getPath())
    for path in found:
        if path.getName().endswith(".txt"):
            store.rename(path, jvm.org.apache.hadoop.fs.Path(path.getParent(), path.getName()[:-4] + ".json"))


def bronze_run_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with six different headers, as one scan."""
    root = scratch_path(spark, "run")
    rows = _landable(spark, sf_dir)
    for n in range(6):
        own = rows.filter(F.col("source_year").cast("int") % 6 == n)
        own = own.select(*COLUMNS[n:], *COLUMNS[:n], F.lit(str(n)).alias(f"Only in-{n}"))
        own.write.csv(f"{root}/landing/SPAIN/2023_LANDING/{n}", header=True, sep=";", encoding="ISO-8859-1")
    ledger = Ledger(spark, f"{root}/ledger")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023", ";", "ISO-88591"))
    return sinks.read_bronze(spark, f"{root}/bronze").drop("ingested_at")


def promote_header_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that begin with a title line and hold their header as a row, from landing to silver."""
    root, irish = scratch_path(spark, "run"), DATASETS["IRELAND_2024"]
    rows = shaping.titled(spark, sf_dir).drop("source_country", "source_year", "ingested_at")
    is_header = F.col(rows.columns[0]).eqNullSafe(F.lit(irish.fields[0].source))
    part = F.when(is_header, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array((F.xxhash64(*rows.columns) % 3 + 3) % 3))
    rows = rows.withColumn("part", F.explode(part))
    rows.write.partitionBy("part").csv(f"{root}/landing/IRELAND/2024_LANDING", header=True, sep=";", encoding="ISO-8859-1")
    ledger = Ledger(spark, f"{root}/ledger")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "IRELAND", "2024", ";", "ISO-88591"))
    _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, irish))
    return sinks.read_silver(spark, f"{root}/silver").drop("silver_created_at")


def silver_run_irish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irish files of 2023, some of whose amounts slid into the date column, from landing to silver."""
    root, irish = scratch_path(spark, "run"), DATASETS["IRELAND_2023"]
    name, town, _, _, code, eagf, eafrd, cofunding = (f.source for f in irish.fields)
    shifted = fixtures.shifted(spark, sf_dir)
    rows = shifted.select(
        F.concat(F.lit("B"), F.col("l_orderkey")).alias(name), F.concat(F.lit("T"), F.col("l_linenumber")).alias(town), F.lit("I.1").alias(code),
        F.col("amount").alias(eagf), F.lit("1.5").alias(eafrd), F.lit(None).cast("string").alias(cofunding), F.col("end_date").alias("end_date_³"),
    )
    rows.write.csv(f"{root}/landing/IRELAND/2023_LANDING", header=True, sep=";", encoding="ISO-8859-1")
    ledger = Ledger(spark, f"{root}/ledger")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "IRELAND", "2023", ";", "ISO-88591"))
    _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, irish))
    return sinks.read_silver(spark, f"{root}/silver").drop("silver_created_at")


def silver_run_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that keeps a further column, the province, beside the contract's."""
    root = scratch_path(spark, "run")
    rows = fixtures.bronze(spark, sf_dir, labels=True).select(*COLUMNS, F.concat(F.lit("P "), F.substring("municipio", 1, 2)).alias("Provincia"))
    rows.write.csv(f"{root}/landing/SPAIN/2023_LANDING", header=True, sep=";", encoding="ISO-8859-1")
    ledger = Ledger(spark, f"{root}/ledger")
    _done(run_bronze(spark, f"{root}/landing", f"{root}/bronze", ledger, "SPAIN", "2023", ";", "ISO-88591"))
    wide = fixtures.SPAIN.with_fields(FieldSpec("province", "provincia"))
    _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, wide))
    written = spark.read.parquet(f"{root}/silver").drop("silver_created_at")
    return written.withColumn("year", F.col("year").cast("string"))


def grain_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger tells of rows and repeated grain values after a run."""
    root, ledger = _bronze(spark, sf_dir, drift=False)
    _done(run_silver(spark, f"{root}/bronze", f"{root}/silver", ledger, fixtures.SPAIN))
    told = ledger.record("SILVER", "SPAIN", "2023").select("dataset_id", "metadata")
    return told.select("dataset_id", *[F.col("metadata")[c].cast("long").alias(c) for c in ("rows", "repeated_grain")])


def master_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master table, and its macro and pivot parts, from one layout by beneficiary."""
    name = f"layout_{uuid.uuid4().hex}"
    silver = materialise(fixtures.silver(spark, sf_dir, labels=True), "silver")
    write_layout(silver, name, scratch_path(spark, "layout"), buckets_for(silver))
    return bucketed_master(spark, name, join=True)


def master_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master table after three datasets were added with wrong rows, two of them replaced, and a fourth taken out."""
    table_ = MasterTable(spark, scratch_path(spark, "master"))
    silver = materialise(fixtures.silver(spark, sf_dir, labels=True), "silver")
    of = {str(n): silver.filter(F.pmod(F.col("year").cast("int"), F.lit(3)) == n) for n in range(3)}
    table_.replace("0", of["0"])
    table_.replace("1", of["2"].withColumn("beneficiary", F.concat("beneficiary", F.lit(" (old)"))))
    table_.replace("2", of["1"].filter("total_eagf_income_support > 20000"))
    table_.replace("3", of["0"])
    table_.replace("1", of["1"])
    table_.replace("2", of["2"])
    table_.replace("3", None)
    return table_.master()


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts of two datasets, the second without a municipality, from their stored profiles."""
    store = ProfileStore(spark, scratch_path(spark, "profiles"))
    rows = fixtures.bronze(spark, sf_dir)
    odd = F.col("source_year").cast("int") % 2 == 1
    store.record("even", rows.filter(~odd))
    store.record("odd", rows.limit(0))
    store.record("odd", rows.filter(odd).drop("municipio"))
    return store.profile().drop("distinct_estimate")


def _land_orders(spark: SparkSession, sf_dir: str) -> str:
    """The keys of ``orders``, in order, as one text file per priority and status."""
    root = scratch_path(spark, "landed")
    rows = table(spark, sf_dir, "orders").select(
        F.concat_ws("-", F.substring("o_orderpriority", 1, 1), "o_orderstatus").alias("folder"), "o_orderkey", F.col("o_orderkey").cast("string").alias("value")
    )
    dealt = rows.repartition("folder").sortWithinPartitions("folder", "o_orderkey").drop("o_orderkey")
    dealt.write.partitionBy("folder").text(root)
    return root


def _folder() -> Column:
    return F.regexp_extract("path", "folder=([^/]*)/", 1).alias("folder")


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed from a table: how many in each folder, and their bytes."""
    found = landing.inventory(spark, _land_orders(spark, sf_dir))
    return found.groupBy(_folder()).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def landed_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of files landed from a table."""
    return landing.file_fingerprints(spark, _land_orders(spark, sf_dir)).select(_folder(), "length", "fingerprint")


def landed_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, piece by piece, of files landed from a table."""
    return landing.content_fingerprints(spark, _land_orders(spark, sf_dir)).select(_folder(), "length", "fingerprint")


QUERIES = {
    "bronze_run_json_documents": bronze_run_json_documents,
    "bronze_run_headers": bronze_run_headers,
    "promote_header_files": promote_header_files,
    "silver_run_irish": silver_run_irish,
    "silver_run_province": silver_run_province,
    "grain_run": grain_run,
    "master_bucketed": master_bucketed,
    "master_incremental": master_incremental,
    "profile_merged": profile_merged,
    "landed_files": landed_files,
    "landed_fingerprints": landed_fingerprints,
    "landed_content": landed_content,
}

_ONLY_SQL = ", ".join(f"CASE WHEN source_year::INTEGER % 6 = {n} THEN '{n}' END AS only_in_{n}" for n in range(6))
_PROFILED = ("beneficiario", "municipio", "source_country", "source_year", "medida", "feaga", "feader", "importecofin")


def _present_sql(c: str) -> str:
    own = f"{c} IS NOT NULL AND trim({c}) NOT IN ('', 'N/A', 'n/a', 'NA', 'na')"
    return own + (" AND source_year::INTEGER % 2 = 0" if c == "municipio" else "")


def _profile_sql(c: str) -> str:
    n = f"(count(*) FILTER (WHERE {_present_sql(c)}))"
    return f"""
SELECT '{c}' AS column_name, count(*) - {n} AS missing_count, round((count(*) - {n})::DOUBLE / count(*) * 100, 2) AS missing_percentage,
  {n} AS non_null_count, 'string' AS dtype FROM b"""


_ORDERS_SQL = "SELECT left(o_orderpriority, 1) || '-' || o_orderstatus AS folder, o_orderkey, o_orderkey || chr(10) AS line FROM orders"

_WORDS_SQL = ", ".join(f"sum(('0x' || substr(d, {1 + 8 * i}, 8))::BIGINT)::VARCHAR" for i in range(4))

ORACLES = {
    "bronze_run_json_documents": _LANDED_SQL,
    "bronze_run_headers": f"""
SELECT beneficiario, municipio, medida, feaga, feader, importecofin, {_ONLY_SQL}, 'SPAIN' AS source_country, '2023' AS source_year
FROM ({LABELLED_BRONZE_SQL})""",
    "promote_header_files": shaping.ORACLES["silver_titled"],
    "silver_run_irish": rf"""
SELECT 'B' || l_orderkey AS beneficiary, 'T' || l_linenumber AS municipality, 'IRELAND' AS country, '2023' AS year, 'I.1' AS intervention_code,
  coalesce(amount, 0.0::DOUBLE) AS total_eagf_income_support, 1.5::DOUBLE AS total_eafrd_income_support, 0.0::DOUBLE AS national_cofunding_amount
FROM ({shaping.ORACLES["repair_shift"]})""",
    "silver_run_province": f"""
WITH s AS ({silver_sql(_LANDED_SQL)})
SELECT s.*, CASE WHEN municipality <> 'UNKNOWN' THEN 'P ' || left(municipality, 2) END AS province FROM s""",
    "grain_run": f"""
SELECT 'SPAIN_2023' AS dataset_id, sum(n)::BIGINT AS rows, count(*) FILTER (WHERE n > 1) AS repeated_grain
FROM (SELECT count(*) AS n FROM ({silver_sql(_LANDED_SQL)}) GROUP BY {', '.join(SILVER_GRAIN)})""",
    "master_bucketed": payouts.ORACLES["beneficiary_master"],
    "master_incremental": payouts.ORACLES["beneficiary_master"],
    "profile_merged": f"WITH b AS ({fixtures.BRONZE_SQL})" + " UNION ALL ".join(_profile_sql(c) for c in _PROFILED),
    "landed_files": f"SELECT folder, 1::BIGINT AS files, sum(strlen(line))::BIGINT AS bytes FROM ({_ORDERS_SQL}) GROUP BY folder",
    "landed_fingerprints": f"""
SELECT folder, sum(strlen(line))::BIGINT AS length, md5(string_agg(line, '' ORDER BY o_orderkey)) AS fingerprint
FROM ({_ORDERS_SQL}) GROUP BY folder""",
    "landed_content": f"""
SELECT folder, sum(size)::BIGINT AS length, concat_ws('-', {_WORDS_SQL}) AS fingerprint
FROM (SELECT folder, size, md5((sum(size) OVER (PARTITION BY folder ORDER BY o_orderkey) - size)::BIGINT || ':' || md5(line[:-2])) AS d
  FROM (SELECT *, strlen(line) AS size FROM ({_ORDERS_SQL}))) GROUP BY folder""",
}
