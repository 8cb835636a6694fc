"""Beneficiary analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import payments
from ..plans import master
from ..taxonomy import SCHEMES
from . import fixtures
from .fixtures import BRONZE_SQL, LABELLED_BRONZE_SQL, MACRO_SQL, PART_SCHEMES, PIVOT_SQL, classified_sql, totals_sql


def merge_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.merge_payments(fixtures.silver(spark, sf_dir))


def merge_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.merge_payments_salted(fixtures.silver(spark, sf_dir))


def payout_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.payout_totals(merge_payments(spark, sf_dir))


def nonzero_payouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.nonzero_payouts(payout_totals(spark, sf_dir))


def identifiable_payouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.identifiable_payouts(payout_totals(spark, sf_dir))


def distinct_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.distinct_schemes(fixtures.silver(spark, sf_dir, labels=True))


def classify_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.prepared_payouts(fixtures.silver(spark, sf_dir), PART_SCHEMES)


def classify_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.prepared_payouts(fixtures.silver(spark, sf_dir, labels=True))


def macro_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.macro_totals(classify_published(spark, sf_dir))


def scheme_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.scheme_pivot(classify_published(spark, sf_dir))


def beneficiary_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.build_master(fixtures.silver(spark, sf_dir, labels=True))


def beneficiary_master_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.build_master_join(fixtures.silver(spark, sf_dir, labels=True))


def group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.group_totals(classify_published(spark, sf_dir))


def top_beneficiaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.top_beneficiaries(classify_published(spark, sf_dir))


QUERIES = {
    "merge_payments": merge_payments,
    "merge_salted": merge_salted,
    "payout_totals": payout_totals,
    "nonzero_payouts": nonzero_payouts,
    "identifiable_payouts": identifiable_payouts,
    "distinct_schemes": distinct_schemes,
    "classify_schemes": classify_schemes,
    "classify_published": classify_published,
    "macro_totals": macro_totals,
    "scheme_pivot": scheme_pivot,
    "beneficiary_master": beneficiary_master,
    "beneficiary_master_join": beneficiary_master_join,
    "group_totals": group_totals,
    "top_beneficiaries": top_beneficiaries,
}

_PUBLISHED_SQL = classified_sql(LABELLED_BRONZE_SQL, SCHEMES)
_MASTER_SQL = f"SELECT beneficiary, {MACRO_SQL},\n  {PIVOT_SQL}\nFROM ({_PUBLISHED_SQL}) GROUP BY beneficiary"

ORACLES = {
    "merge_payments": fixtures.merged_sql(),
    "merge_salted": fixtures.merged_sql(),
    "payout_totals": totals_sql(),
    "nonzero_payouts": f"SELECT * FROM ({totals_sql()}) WHERE grand_total_public_payout <> 0.0",
    "identifiable_payouts": f"SELECT * FROM ({totals_sql()}) WHERE beneficiary <> 'UNKNOWN'",
    "distinct_schemes": f"""
SELECT DISTINCT intervention_code FROM ({fixtures.silver_sql(LABELLED_BRONZE_SQL)})
WHERE intervention_code NOT IN ('', 'N/A', 'n/a', 'NA', 'na')""",
    "classify_schemes": classified_sql(BRONZE_SQL, PART_SCHEMES),
    "classify_published": _PUBLISHED_SQL,
    "macro_totals": f"SELECT beneficiary, {MACRO_SQL} FROM ({_PUBLISHED_SQL}) GROUP BY beneficiary",
    "scheme_pivot": f"SELECT beneficiary, {PIVOT_SQL} FROM ({_PUBLISHED_SQL}) GROUP BY beneficiary",
    "beneficiary_master": _MASTER_SQL,
    "beneficiary_master_join": _MASTER_SQL,
    "group_totals": f"""
SELECT group_name, {fixtures.sum_sql('grand_total_public_payout')} AS grand_total_public_payout, count(*) AS payments
FROM ({_PUBLISHED_SQL}) GROUP BY group_name""",
    "top_beneficiaries": f"""
SELECT beneficiary, {MACRO_SQL} FROM ({_PUBLISHED_SQL}) GROUP BY beneficiary
ORDER BY grand_total_public_payout DESC, beneficiary LIMIT 10""",
}
