"""Profiles, schema and quality reports, the ledger view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile, quality, shape
from ..plans import ledger
from ..plans.silver import intake_report as build_intake_report
from ..spec import AMOUNT_COLUMNS, SILVER_GRAIN, SILVER_SCHEMA, TEXT_COLUMNS
from . import fixtures
from .fixtures import BRONZE_SQL, table

BRONZE_COLUMNS = (
    "beneficiario", "municipio", "source_country", "source_year", "medida", "feaga", "feader", "importecofin"
)


def completeness_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.completeness_counts(fixtures.bronze(spark, sf_dir))


def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_profile(fixtures.bronze(spark, sf_dir))


def distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_profile(fixtures.bronze(spark, sf_dir))


def duplicate_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_grain(fixtures.silver(spark, sf_dir), SILVER_GRAIN)


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    off = (
        fixtures.silver(spark, sf_dir)
        .drop("municipality")
        .withColumn("year", F.col("year").cast("int"))
        .withColumn("province", F.lit("-"))
    )
    return quality.schema_report(off, SILVER_SCHEMA)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(fixtures.defective(spark, sf_dir), ["v", "t"], ["v"])


def quality_prefill(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = shape.map_columns(fixtures.bronze(spark, sf_dir), fixtures.SPAIN)
    return quality.quality_report(mapped, (*TEXT_COLUMNS, *AMOUNT_COLUMNS), AMOUNT_COLUMNS)


def intake_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_intake_report(fixtures.bronze(spark, sf_dir), fixtures.SPAIN)


def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest_per_key(
        table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_type", "value"]
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return ledger_current(spark, sf_dir).select(
        F.col("user_id").alias("key"), F.when(kind != "error", kind).alias("fingerprint")
    )


def pending_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("c_custkey") % 3
    wanted = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.when(turn == 0, "view").when(turn == 1, "click").alias("fingerprint")
    )
    return ledger.pending(wanted, _records(spark, sf_dir), ["key"])


QUERIES = {
    "completeness_counts": completeness_counts,
    "missing_profile": missing_profile,
    "distinct_profile": distinct_profile,
    "duplicate_grain": duplicate_grain,
    "schema_report": schema_report,
    "quality_report": quality_report,
    "quality_prefill": quality_prefill,
    "intake_report": intake_report,
    "ledger_current": ledger_current,
    "pending_datasets": pending_datasets,
}


def _union(rows: list[str], prefix: str) -> str:
    return f"WITH b AS ({prefix}) " + " UNION ALL ".join(rows)


def _present(c: str) -> str:
    return f"count(CASE WHEN {c} IS NOT NULL AND trim({c}) NOT IN ('', 'N/A', 'n/a', 'NA', 'na') THEN 1 END)"


_MAPPED_SQL = f"""
SELECT beneficiario AS beneficiary, municipio AS municipality, source_country AS country, source_year AS year,
  medida AS intervention_code, {fixtures.amount_sql('feaga')} AS total_eagf_income_support,
  {fixtures.amount_sql('feader')} AS total_eafrd_income_support,
  {fixtures.amount_sql('importecofin')} AS national_cofunding_amount, feaga, feader, importecofin
FROM ({BRONZE_SQL})"""

_RULES = [
    ("not_empty", "", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT"),
    *[("not_null", c, f"count(*) FILTER ({c} IS NULL)") for c in (*TEXT_COLUMNS, *AMOUNT_COLUMNS)],
    *[("not_blank", c, f"count(*) FILTER ({c} = '')") for c in TEXT_COLUMNS],
    *[("finite", c, f"count(*) FILTER (isnan({c}) OR isinf({c}))") for c in AMOUNT_COLUMNS],
]
_SOURCE_OF = dict(zip(AMOUNT_COLUMNS, ("feaga", "feader", "importecofin")))
_LEDGER_SQL = """
SELECT user_id, min(ts) AS created_at, max(ts) AS updated_at,
  arg_max(event_type, {'ts': ts, 'event_id': event_id}) AS event_type,
  arg_max(value, {'ts': ts, 'event_id': event_id}) AS value
FROM events GROUP BY user_id"""
_CONTRACT = ",".join(SILVER_SCHEMA.names)

ORACLES = {
    "completeness_counts": _union(
        [f"SELECT '{c}' AS column_name, {_present(c)} AS valid_count FROM b" for c in BRONZE_COLUMNS], BRONZE_SQL
    ),
    "missing_profile": _union(
        [
            f"SELECT '{c}' AS column_name, count(*) - {_present(c)} AS missing_count, "
            f"round((count(*) - {_present(c)}) / count(*) * 100, 2) AS missing_percentage, "
            f"{_present(c)} AS non_null_count, 'string' AS dtype FROM b"
            for c in BRONZE_COLUMNS
        ],
        BRONZE_SQL,
    ),
    "distinct_profile": _union(
        [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM b" for c in BRONZE_COLUMNS],
        BRONZE_SQL,
    ),
    "duplicate_grain": f"""
SELECT beneficiary, intervention_code, municipality, count(*) AS row_count FROM ({fixtures.silver_sql()})
GROUP BY ALL HAVING count(*) > 1""",
    "schema_report": f"""
SELECT r.*, (SELECT count(*) FROM ({BRONZE_SQL})) AS affected_rows FROM (VALUES
  ('missing_column', 'municipality', 'string', ''), ('missing_column', 'silver_created_at', 'timestamp', ''),
  ('extra_column', 'province', '', 'string'), ('column_type', 'year', 'string', 'int'),
  ('column_order', '', '{_CONTRACT}',
   '{",".join([c for c in SILVER_SCHEMA.names if c not in ("municipality", "silver_created_at")] + ["province"])}')
) r(rule, column_name, expected, actual)""",
    "quality_report": _union(
        [
            "SELECT 'not_empty' AS rule, '' AS column_name, (count(*) = 0)::BIGINT AS violations FROM b",
            "SELECT 'not_null', 'v', count(*) FILTER (v IS NULL) FROM b",
            "SELECT 'not_null', 't', count(*) FILTER (t IS NULL) FROM b",
            "SELECT 'not_blank', 't', count(*) FILTER (t = '') FROM b",
            "SELECT 'finite', 'v', count(*) FILTER (isnan(v) OR isinf(v)) FROM b",
        ],
        fixtures.DEFECTIVE_SQL,
    ),
    "quality_prefill": _union(
        [f"SELECT '{r}' AS rule, '{c}' AS column_name, {n} AS violations FROM b" for r, c, n in _RULES], _MAPPED_SQL
    ),
    "intake_report": _union(
        ["SELECT 'rows' AS metric, count(*) AS value FROM b"]
        + [f"SELECT 'missing_{c}', count(*) FILTER ({c} IS NULL) FROM b" for c in (*TEXT_COLUMNS, *AMOUNT_COLUMNS)]
        + [
            f"SELECT 'unparsed_{c}', count(*) FILTER ({raw} IS NOT NULL AND trim({raw}) <> '' AND {c} IS NULL) FROM b"
            for c, raw in _SOURCE_OF.items()
        ],
        _MAPPED_SQL,
    ),
    "ledger_current": _LEDGER_SQL,
    "pending_datasets": f"""
SELECT w.key, w.fingerprint FROM (
  SELECT c_custkey AS key, CASE c_custkey % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' END AS fingerprint FROM customer) w
WHERE NOT EXISTS (SELECT 1 FROM ({_LEDGER_SQL}) d WHERE d.user_id = w.key
  AND w.fingerprint IS NOT DISTINCT FROM CASE WHEN d.event_type <> 'error' THEN d.event_type END)""",
}
