"""The catalog of published sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = (
    "country string, country_code string, currency string, engine string, year string, "
    "delimiter string, encoding string, has_header boolean, schema_version string"
)

# The published sources, in catalog order. Values are as catalogued, including the
# misspelt encoding label and missing entries.
SOURCES = (
    ("SPAIN", "ES", "EUR", "zip_csv", "2024", ";", "ISO-8859-1", True, "v1"),
    ("SPAIN", "ES", "EUR", "zip_csv", "2023", ";", "ISO-88591", True, "v1"),
    ("GERMANY", "DE", "EUR", "csv", "2024", ";", "latin-1", True, "v1"),
    ("GERMANY", "DE", "EUR", "csv", "2023", ";", "latin-1", True, "v1"),
    ("IRELAND", "IE", "EUR", "mixed", "2024", ",", "latin-1", True, "v1"),
    ("IRELAND", "IE", "EUR", "mixed", "2023", ",", "latin-1", True, "v1"),
    ("UK", "UK", "BP", "scraper", "2024", ",", "utf-8", None, "v1"),
    ("UK", "UK", "BP", "scraper", "2023", ",", "utf-8", True, "v1"),
    ("NETHERLANDS", "NED", "EUR", "scraper", "2023", None, None, True, "v1"),
    ("NETHERLANDS", "NED", "EUR", "scraper", "2024", None, None, True, "v1"),
    ("FRANCE", "FR", "EUR", "scraper", "2023", None, None, True, "v1"),
    ("FRANCE", "FR", "EUR", "scraper", "2024", None, None, True, "v1"),
)

# The engine whose sources are not ingested, and the one country exempt from that.
SCRAPED_ENGINE = "scraper"
SCRAPED_BUT_FETCHED = "UK"


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, CATALOG_SCHEMA)


def active_sources(sources: DataFrame, exempt: str = SCRAPED_BUT_FETCHED) -> DataFrame:
    """Sources that can be ingested: all but scraped portals, the exempt country aside."""
    scraped = F.col("engine").eqNullSafe(SCRAPED_ENGINE)
    return sources.filter(~scraped | (F.upper("country") == exempt))
