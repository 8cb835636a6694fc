"""Inputs shaped like landed payment files, derived from the given tables: as DataFrames for the
queries and, written independently, as SQL for their oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import to_silver
from ..spec import DATASETS
from ..taxonomy import OTHER_SLUG, SCHEMES, Scheme, slugs

SPAIN = DATASETS["SPAIN_2023"]

# A small taxonomy over part types.
PART_SCHEMES = (
    Scheme("ECONOMY", "Economy parts", "Group A", "slug_a"),
    Scheme("LARGE", "Large parts", "Group A", "slug_a"),
    Scheme("MEDIUM", "Medium parts", "Group B", "slug_b"),
)

# The published labels, and two that are in no taxonomy (one by a missing accent).
LABELS = [s.raw_code for s in SCHEMES] + ["22400 - Monzon", "X.1   Otra medida"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money_text(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def comma_text(c: str) -> Column:
    return F.replace(money_text(c), F.lit("."), F.lit(","))


def bronze(spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    """Spanish layout: one row per line item, with NULLs, markers and unparsable amounts mixed in.
    ``labels=True`` puts published scheme labels in place of part types."""
    lineitem, orders, customer, nation, part = (
        table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "part")
    )
    scheme = F.col("p_type")
    if labels:
        scheme = F.element_at(
            F.array(*[F.lit(v) for v in LABELS]), (F.pmod("p_partkey", F.lit(len(LABELS))) + 1).cast("int")
        )
    # Who ordered is found before the line items come in, whose many rows so are shuffled by order and by part only.
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        lineitem.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("c_name").alias("beneficiario"),
            F.when(F.col("l_linenumber") != 5, F.col("n_name")).alias("municipio"),
            F.lit("SPAIN").alias("source_country"),
            F.year("o_orderdate").cast("string").alias("source_year"),
            F.when(F.col("l_orderkey") % 53 != 0, scheme).alias("medida"),
            F.when(F.col("l_orderkey") % 97 == 0, "N/A")
            .when(F.col("l_orderkey") % 31 == 0, "1.234,56")
            .otherwise(comma_text("l_extendedprice"))
            .alias("feaga"),
            F.when(F.col("l_linenumber") != 3, comma_text("l_quantity")).alias("feader"),
            comma_text("l_tax").alias("importecofin"),
        )
    )


def silver(spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    """The bronze fixture in the silver contract, without the audit column."""
    return to_silver(bronze(spark, sf_dir, labels), SPAIN).drop("silver_created_at")


def shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irish layout: some amounts slid into the date cell."""
    key, amount = F.col("l_orderkey"), money_text("l_extendedprice")
    slid = key % 11 == 0
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(slid, amount).otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("end_date"),
        F.when(slid & (F.col("l_linenumber") % 2 == 0), F.lit(None))
        .when(slid, "0")
        .when(key % 13 == 0, "N/A")
        .otherwise(amount)
        .alias("amount"),
    )


def defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An amount with NaN, infinity and NULL, and a text with blanks."""
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(line == 2, float("nan"))
        .when(line == 4, float("inf"))
        .when(line != 6, F.col("l_tax"))
        .alias("v"),
        F.when(line == 1, "").otherwise(F.col("l_returnflag")).alias("t"),
    )


# --- the same inputs as SQL --------------------------------------------------------------------


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _bronze_sql(scheme: str) -> str:
    return f"""
SELECT c.c_name AS beneficiario,
  CASE WHEN l.l_linenumber = 5 THEN NULL ELSE n.n_name END AS municipio,
  'SPAIN' AS source_country,
  CAST(year(o.o_orderdate) AS VARCHAR) AS source_year,
  CASE WHEN l.l_orderkey % 53 = 0 THEN NULL ELSE {scheme} END AS medida,
  CASE WHEN l.l_orderkey % 97 = 0 THEN 'N/A'
       WHEN l.l_orderkey % 31 = 0 THEN '1.234,56'
       ELSE replace(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS feaga,
  CASE WHEN l.l_linenumber = 3 THEN NULL
       ELSE replace(CAST(CAST(l.l_quantity AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS feader,
  replace(CAST(CAST(l.l_tax AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS importecofin
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey"""


BRONZE_SQL = _bronze_sql("p.p_type")
LABELLED_BRONZE_SQL = _bronze_sql(f"([{', '.join(sql_text(v) for v in LABELS)}])[p.p_partkey % {len(LABELS)} + 1]")

SHIFTED_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 11 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
       ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS end_date,
  CASE WHEN l_orderkey % 11 = 0 AND l_linenumber % 2 = 0 THEN NULL
       WHEN l_orderkey % 11 = 0 THEN '0'
       WHEN l_orderkey % 13 = 0 THEN 'N/A'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount
FROM lineitem"""

DEFECTIVE_SQL = """
SELECT l_orderkey,
  CASE WHEN l_linenumber = 2 THEN CAST('NaN' AS DOUBLE)
       WHEN l_linenumber = 4 THEN CAST('Infinity' AS DOUBLE)
       WHEN l_linenumber = 6 THEN NULL ELSE l_tax END AS v,
  CASE WHEN l_linenumber = 1 THEN '' ELSE l_returnflag END AS t
FROM lineitem"""


def amount_sql(column: str) -> str:
    return f"try_cast(replace({column}, ',', '.') AS DOUBLE)"


def filled_sql(amount: str) -> str:
    return f"CASE WHEN ({amount}) IS NULL OR isnan({amount}) THEN 0.0::DOUBLE ELSE ({amount}) END"


def silver_sql(bronze_sql: str = BRONZE_SQL, parse=amount_sql) -> str:
    return f"""
SELECT coalesce(beneficiario, 'UNKNOWN') AS beneficiary,
  coalesce(municipio, 'UNKNOWN') AS municipality,
  coalesce(source_country, 'UNKNOWN') AS country,
  coalesce(source_year, 'UNKNOWN') AS year,
  coalesce(medida, 'UNKNOWN') AS intervention_code,
  {filled_sql(parse('feaga'))} AS total_eagf_income_support,
  {filled_sql(parse('feader'))} AS total_eafrd_income_support,
  {filled_sql(parse('importecofin'))} AS national_cofunding_amount
FROM ({bronze_sql})"""


def sum_sql(column: str) -> str:
    return f"sum(CAST({column} AS DECIMAL(18,2)))::DOUBLE"


def merged_sql(bronze_sql: str = BRONZE_SQL) -> str:
    return f"""
SELECT beneficiary, intervention_code,
  {sum_sql('total_eagf_income_support')} AS total_eagf_income_support,
  {sum_sql('total_eafrd_income_support')} AS total_eafrd_income_support,
  {sum_sql('national_cofunding_amount')} AS national_cofunding_amount,
  min(country) AS country, min(year) AS year, min(municipality) AS municipality
FROM ({silver_sql(bronze_sql)}) GROUP BY beneficiary, intervention_code"""


def totals_sql(bronze_sql: str = BRONZE_SQL) -> str:
    return f"""
SELECT *, total_eagf_income_support + total_eafrd_income_support AS grand_total_eu_payout,
  total_eagf_income_support + total_eafrd_income_support + national_cofunding_amount AS grand_total_public_payout
FROM ({merged_sql(bronze_sql)})"""


def classified_sql(bronze_sql: str, schemes: tuple[Scheme, ...]) -> str:
    rows = ", ".join("(" + ", ".join(sql_text(v) for v in s) + ")" for s in schemes)
    return f"""
SELECT t.*, v.english, v.group_name, coalesce(v.slug, '{OTHER_SLUG}') AS scheme_token
FROM ({totals_sql(bronze_sql)}) t
LEFT JOIN (VALUES {rows}) v(raw_code, english, group_name, slug) ON t.intervention_code = v.raw_code
WHERE grand_total_public_payout <> 0.0 AND beneficiary <> 'UNKNOWN'"""


MACRO_SQL = f"""{sum_sql('total_eagf_income_support')} AS total_eagf_income_support,
  {sum_sql('total_eafrd_income_support')} AS total_eafrd_income_support,
  {sum_sql('grand_total_public_payout')} AS grand_total_public_payout"""

PIVOT_SQL = ",\n  ".join(
    f"coalesce(sum(CASE WHEN scheme_token = '{s}' THEN CAST(grand_total_public_payout AS DECIMAL(18,2)) END)::DOUBLE,"
    f" 0.0::DOUBLE) AS {s}"
    for s in slugs(SCHEMES)
)
