"""From silver to beneficiary analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import payments
from ..taxonomy import SCHEMES, Scheme


def prepared_payouts(silver: DataFrame, schemes: Sequence[Scheme] = SCHEMES) -> DataFrame:
    """Merged, totalled, non-zero, identifiable and classified payouts.

    Unknown beneficiaries are filtered by merge key, so Spark drops them before the first shuffle.
    """
    return (
        silver.transform(payments.merge_payments)
        .transform(payments.payout_totals)
        .transform(payments.nonzero_payouts)
        .transform(payments.identifiable_payouts)
        .transform(payments.classify_schemes, schemes)
    )


def build_master(silver: DataFrame, schemes: Sequence[Scheme] = SCHEMES) -> DataFrame:
    """The wide beneficiary table."""
    return payments.beneficiary_master(prepared_payouts(silver, schemes), schemes)


def build_master_join(silver: DataFrame, schemes: Sequence[Scheme] = SCHEMES) -> DataFrame:
    return payments.beneficiary_master_join(prepared_payouts(silver, schemes), schemes)
