"""Names, provenance, mapping, amounts, fills, repairs, union and the silver contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.amounts import comma_amount, parse_failed, plain_amount
from ..functions.names import normalise_columns
from ..operators import repair, shape
from ..operators.profile import distinct_rows
from ..spec import DATASETS
from . import fixtures
from .fixtures import BRONZE_SQL, SHIFTED_SQL, money_text, table


def bronze_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze(spark, sf_dir)


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    raw = [" Order-Key ", "Cust/Key", "Order Status", "Total  Price", "order-status", "Prior`ity"]
    return normalise_columns(orders.toDF(*raw))


def enrich_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return shape.stamp_provenance(orders, "SPAIN", "2023").drop("ingested_at")


def map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.map_columns(fixtures.bronze(spark, sf_dir), fixtures.SPAIN)


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irish 2024 layout: a title in place of the header, the header as a data row."""
    names = ("information_for_transparency", "unnamed:_1", "unnamed:_2", "unnamed:_3", "unnamed:_4", "unnamed:_5")
    sources = [f.source for f in DATASETS["IRELAND_2024"].fields if not f.source.startswith("source_")]
    header = spark.range(1).select(*[F.lit(s).alias(n) for s, n in zip(sources, names)])
    balance = money_text("c_acctbal")
    rows = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 17 != 0, F.col("c_name")).alias(names[0]),
        F.concat(F.lit("Town "), F.col("c_nationkey").cast("string")).alias(names[1]),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias(names[2]),
        balance.alias(names[3]),
        F.when(F.col("c_custkey") % 3 == 0, "n/a").otherwise(balance).alias(names[4]),
        F.lit("1,5").alias(names[5]),
    )
    return shape.stamp_provenance(rows.unionByName(header), "IRELAND", "2024")


def promote_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    irish = DATASETS["IRELAND_2024"]
    promoted = shape.promote_header(titled(spark, sf_dir), irish.fields[0].source).drop("ingested_at")
    return promoted.select(*[F.col(f"`{c}`").alias(c.lower().replace(" ", "_").replace("/", "_"))
                             for c in promoted.columns])


def silver_titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.to_silver(titled(spark, sf_dir), DATASETS["IRELAND_2024"]).drop("silver_created_at")


def cast_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.shifted(spark, sf_dir).select("l_orderkey", "l_linenumber", plain_amount("amount").alias("amount"))


def comma_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze(spark, sf_dir).select(
        "feaga",
        comma_amount("feaga").alias("amount"),
        comma_amount("feaga", thousands_sep=".").alias("amount_thousands"),
        parse_failed("feaga", comma_amount("feaga")).alias("unparsed"),
    )


def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.defective(spark, sf_dir).withColumn("u", F.when(F.col("t") != "N", F.col("t")))
    return shape.fill_missing(rows, ["t", "u"], ["v"])


def repair_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = repair.repair_shift(fixtures.shifted(spark, sf_dir), "end_date", "amount")
    return fixed.withColumn("amount", plain_amount("amount"))


def shift_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.shift_suspects(fixtures.shifted(spark, sf_dir), "end_date")


def shift_repaired_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.shift_repaired_rows(repair_shift(spark, sf_dir), "end_date", "amount")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.silver(spark, sf_dir)


def union_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O-"), F.col("o_orderkey")).alias("key"), F.col("o_orderstatus").alias("status")
    )
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag")
    )
    return shape.union_by_name([shape.as_text(orders), shape.as_text(items)])


def _irish(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = DATASETS["IRELAND_2023"]
    name, town, _, _, code, eagf, eafrd, cofunding = (f.source for f in spec.fields)
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias(name),
        F.col("c_nationkey").cast("string").alias(town),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias(code),
        money_text("c_acctbal").alias(eagf),
        F.lit("NaN").alias(eafrd),
        F.lit(None).cast("string").alias(cofunding),
    )
    return shape.to_silver(shape.stamp_provenance(rows, "IRELAND", "2023"), spec)


def _german(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns named as in a UTF-8 file that was decoded as ISO-8859-1."""
    spec = DATASETS["GERMANY_2024"]
    name, town, _, _, code, eagf, eafrd, cofunding = ((f.aliases or (f.source,))[0] for f in spec.fields)
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias(name),
        F.col("s_nationkey").cast("string").alias(town),
        F.lit("I.1").alias(code),
        F.lit("12.5").alias(eagf),
        F.lit("1,5").alias(eafrd),
        money_text("s_acctbal").alias(cofunding),
    )
    return shape.to_silver(shape.stamp_provenance(rows, "GERMANY", "2024"), spec)


def silver_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    spanish = shape.to_silver(fixtures.bronze(spark, sf_dir), fixtures.SPAIN)
    frames = [spanish, _irish(spark, sf_dir), _german(spark, sf_dir)]
    return shape.union_by_name(frames).drop("silver_created_at")


def distinct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(
        fixtures.bronze(spark, sf_dir), ["beneficiario", "medida", "source_year", "municipio", "importecofin"]
    )


QUERIES = {
    "bronze_fixture": bronze_fixture,
    "normalize_names": normalize_names,
    "enrich_provenance": enrich_provenance,
    "map_columns": map_columns,
    "promote_header": promote_header,
    "silver_titled": silver_titled,
    "cast_amounts": cast_amounts,
    "comma_decimal": comma_decimal,
    "fill_nulls": fill_nulls,
    "repair_shift": repair_shift,
    "shift_suspects": shift_suspects,
    "shift_repaired_rows": shift_repaired_rows,
    "silver": silver,
    "union_drift": union_drift,
    "silver_all": silver_all,
    "distinct_projection": distinct_projection,
}

_REPAIRED_SQL = r"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN moved THEN try_cast(end_date AS DOUBLE) ELSE try_cast(amount AS DOUBLE) END AS amount,
  CASE WHEN moved THEN NULL ELSE end_date END AS end_date
FROM (SELECT *, regexp_matches(end_date, '^\d+(\.\d+)?$')
        AND (amount IS NULL OR coalesce(try_cast(amount AS DOUBLE) = 0.0, false)) AS moved
      FROM (""" + SHIFTED_SQL + "))"

_TITLED_SQL = """
SELECT CASE WHEN c_custkey % 17 <> 0 THEN c_name END AS name, 'Town ' || c_nationkey AS town,
  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS code,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS eagf,
  CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS eafrd
FROM customer WHERE c_custkey % 17 <> 0"""

ORACLES = {
    "bronze_fixture": BRONZE_SQL,
    "normalize_names": """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status,
  o_totalprice AS total__price, o_orderdate AS order_status_2, o_orderpriority AS "prior`ity" FROM orders""",
    "enrich_provenance": """
SELECT o_orderkey, o_totalprice, 'SPAIN' AS source_country, '2023' AS source_year FROM orders""",
    "map_columns": f"""
SELECT beneficiario AS beneficiary, municipio AS municipality, source_country AS country, source_year AS year,
  medida AS intervention_code, try_cast(replace(feaga, ',', '.') AS DOUBLE) AS total_eagf_income_support,
  try_cast(replace(feader, ',', '.') AS DOUBLE) AS total_eafrd_income_support,
  try_cast(replace(importecofin, ',', '.') AS DOUBLE) AS national_cofunding_amount
FROM ({BRONZE_SQL})""",
    "promote_header": f"""
SELECT name AS name_of_the_beneficiary_legal_entity_association, town AS municipality,
  code AS code_of_measure_type_of_intervention_sector_as_set_in_annex_ix,
  eagf AS amount_by_operation_under_eagf, eafrd AS amount_by_operation_under_eafrd,
  '1,5' AS "amount_by_operation_under_co-financing", 'IRELAND' AS source_country, '2024' AS source_year
FROM ({_TITLED_SQL})""",
    "silver_titled": f"""
SELECT name AS beneficiary, town AS municipality, 'IRELAND' AS country, '2024' AS year,
  coalesce(code, 'UNKNOWN') AS intervention_code,
  coalesce(try_cast(eagf AS DOUBLE), 0.0::DOUBLE) AS total_eagf_income_support,
  coalesce(try_cast(eafrd AS DOUBLE), 0.0::DOUBLE) AS total_eafrd_income_support,
  0.0::DOUBLE AS national_cofunding_amount
FROM ({_TITLED_SQL})""",
    "cast_amounts": f"""
SELECT l_orderkey, l_linenumber, try_cast(amount AS DOUBLE) AS amount FROM ({SHIFTED_SQL})""",
    "comma_decimal": f"""
SELECT feaga, try_cast(replace(feaga, ',', '.') AS DOUBLE) AS amount,
  try_cast(replace(replace(feaga, '.', ''), ',', '.') AS DOUBLE) AS amount_thousands,
  feaga IS NOT NULL AND trim(feaga) <> '' AND try_cast(replace(feaga, ',', '.') AS DOUBLE) IS NULL AS unparsed
FROM ({BRONZE_SQL})""",
    "fill_nulls": f"""
SELECT l_orderkey, {fixtures.filled_sql('v')} AS v, coalesce(t, 'UNKNOWN') AS t,
  coalesce(CASE WHEN t <> 'N' THEN t END, 'UNKNOWN') AS u
FROM ({fixtures.DEFECTIVE_SQL})""",
    "repair_shift": _REPAIRED_SQL,
    "shift_suspects": rf"SELECT * FROM ({SHIFTED_SQL}) WHERE regexp_matches(end_date, '^\d+(\.\d+)?$')",
    "shift_repaired_rows": f"""
SELECT * FROM ({_REPAIRED_SQL}) WHERE amount > 0.0 AND (end_date IS NULL OR end_date = 'None')""",
    "silver": fixtures.silver_sql(),
    "union_drift": """
SELECT 'O-' || o_orderkey AS key, o_orderstatus AS status, NULL::VARCHAR AS line, NULL::VARCHAR AS flag FROM orders
UNION ALL SELECT l_orderkey::VARCHAR, NULL, l_linenumber::VARCHAR, l_returnflag FROM lineitem""",
    "silver_all": f"""
SELECT * FROM ({fixtures.silver_sql()})
UNION ALL
SELECT c_name, c_nationkey::VARCHAR, 'IRELAND', '2023',
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE 'UNKNOWN' END,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM customer
UNION ALL
SELECT s_name, s_nationkey::VARCHAR, 'GERMANY', '2024', 'I.1', 12.5::DOUBLE, 0.0::DOUBLE,
  CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) FROM supplier""",
    "distinct_projection": f"""
SELECT DISTINCT beneficiario, medida, source_year, municipio, importecofin FROM ({BRONZE_SQL})""",
}
