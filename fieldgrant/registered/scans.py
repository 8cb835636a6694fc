"""Sources, sinks, fingerprints and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import active_sources
from ..functions.fingerprints import dataset_fingerprint
from ..operators.shape import as_text
from ..sources import landing, readers, sinks
from ..sources.scratch import scratch_path
from . import fixtures
from .fixtures import table


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_files(spark, f"{sf_dir}/orders.parquet", ".parquet")


def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    rows = table(spark, sf_dir, "orders").withColumn("o_totalprice", fixtures.money_text("o_totalprice"))
    as_text(rows).write.csv(path, header=True, sep=";", encoding="ISO-8859-1")
    return readers.read_files(spark, path, ".csv", delimiter=";", encoding="latin-1", same_header=True)


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-json")
    rows = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    rows.write.json(path)
    return readers.read_json(spark, path, schema=rows.schema, lines=True)


#: Keys per landed document; a document is read by one task.
KEYS_PER_DOCUMENT = 10_000


def scan_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part-json")
    rows = table(spark, sf_dir, "part").select(
        F.floor(F.col("p_partkey") / KEYS_PER_DOCUMENT).alias("document"),
        F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"),
    )
    listed = F.array_join(F.collect_list("value"), ",\n")
    documents = rows.groupBy("document").agg(F.concat(F.lit("[\n"), listed, F.lit("\n]")).alias("value"))
    documents.write.partitionBy("document").text(path)
    return readers.read_files(spark, path, ".json").drop("document")


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    rows = fixtures.bronze(spark, sf_dir)
    sinks.write_bronze(rows.withColumn("ingested_at", F.current_timestamp()), path, rebalance=True)
    return sinks.read_bronze(spark, path, rows.columns).select(*rows.columns)


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    rows = fixtures.silver(spark, sf_dir)
    sinks.write_silver(rows.withColumn("silver_created_at", F.current_timestamp()), path, rebalance=True)
    return sinks.read_silver(spark, path).drop("silver_created_at")


def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.inventory(spark, sf_dir).select("file_name", "length")


def file_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.file_fingerprints(spark, sf_dir).drop("path")


def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("fingerprint"))


def documents_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text"))


def catalog_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    sources = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.when(F.col("n_nationkey") == 0, "Uk").otherwise(F.col("n_name")).alias("country"),
            F.when(segment == "MACHINERY", "scraper").when(segment != "BUILDING", "csv").alias("engine"),
        )
    )
    return active_sources(sources)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.page_links(table(spark, sf_dir, "pages"))


def first_matching_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.first_matching_link(table(spark, sf_dir, "pages"), "an", ("TION", "the", "and"))


QUERIES = {
    "scan_delimited": scan_delimited,
    "scan_json": scan_json,
    "scan_json_documents": scan_json_documents,
    "scan_parquet": scan_parquet,
    "landing_inventory": landing_inventory,
    "file_fingerprints": file_fingerprints,
    "content_fingerprint": content_fingerprint,
    "dataset_fingerprint": documents_fingerprint,
    "bronze_roundtrip": bronze_roundtrip,
    "silver_roundtrip": silver_roundtrip,
    "catalog_active": catalog_active,
    "page_links": page_links,
    "first_matching_link": first_matching_link,
}

_LINKS_SQL = r"""
SELECT page_id, url, unnest(hrefs) AS link, unnest(range(len(hrefs)))::INTEGER AS position
FROM (SELECT page_id, url, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1) AS hrefs FROM pages)"""

ORACLES = {
    "scan_delimited": """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
  o_orderdate::VARCHAR AS o_orderdate, o_orderpriority FROM orders""",
    "scan_json": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority
FROM orders""",
    "scan_json_documents": """
SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part""",
    "scan_parquet": "SELECT * FROM orders",
    "content_fingerprint": "SELECT doc_id, md5(text) AS fingerprint FROM documents",
    "dataset_fingerprint": """
SELECT count(*) AS row_count,
  concat_ws('-', sum(('0x' || substr(d, 1, 8))::BIGINT)::VARCHAR, sum(('0x' || substr(d, 9, 8))::BIGINT)::VARCHAR,
    sum(('0x' || substr(d, 17, 8))::BIGINT)::VARCHAR, sum(('0x' || substr(d, 25, 8))::BIGINT)::VARCHAR) AS fingerprint
FROM (SELECT md5(coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(length(text) || ':' || text, '-')) AS d
  FROM documents)""",
    "bronze_roundtrip": fixtures.BRONZE_SQL,
    "silver_roundtrip": fixtures.silver_sql(),
    "catalog_active": """
SELECT * FROM (
  SELECT c_custkey, CASE WHEN n_nationkey = 0 THEN 'Uk' ELSE n_name END AS country,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'scraper' WHEN c_mktsegment <> 'BUILDING' THEN 'csv' END AS engine
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
WHERE engine IS DISTINCT FROM 'scraper' OR upper(country) = 'UK'""",
    "page_links": f"SELECT page_id, position, link FROM ({_LINKS_SQL})",
    "first_matching_link": f"""
SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || arg_min(link, position) AS link FROM ({_LINKS_SQL})
WHERE contains(link, 'an')
  AND (contains(lower(link), 'tion') OR contains(lower(link), 'the') OR contains(lower(link), 'and'))
GROUP BY page_id, url""",
}
