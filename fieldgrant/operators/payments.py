"""Beneficiary analytics: merge payments, classify schemes, build the wide master table.

Every aggregation sums before it shuffles, so a beneficiary, scheme or group that holds most of
the rows reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import cents, exact_sum
from ..functions.missing import MISSING_TEXTS
from ..spec import AMOUNT_COLUMNS, TEXT_COLUMNS, UNKNOWN_TEXT
from ..taxonomy import BROADCAST_LABELS, OTHER_SLUG, SCHEMES, Scheme, slugs, taxonomy_frame

MERGE_KEYS = ("beneficiary", "intervention_code")
REPRESENTATIVES = ("country", "year", "municipality")
EAGF, EAFRD, COFUNDING = AMOUNT_COLUMNS
EU_PAYOUT = "grand_total_eu_payout"
PUBLIC_PAYOUT = "grand_total_public_payout"
MACRO_COLUMNS = (EAGF, EAFRD, PUBLIC_PAYOUT)
SLUG = "scheme_token"
#: Share of all rows from which a key is summed in sub-groups first.
HEAVY_SHARE = 0.02


def _sums(columns: Sequence[str]) -> list[Column]:
    return [exact_sum(c).alias(c) for c in columns]


def merge_payments(
    df: DataFrame,
    keys: Sequence[str] = MERGE_KEYS,
    amounts: Sequence[str] = AMOUNT_COLUMNS,
    representatives: Sequence[str] = REPRESENTATIVES,
) -> DataFrame:
    """One row per beneficiary and scheme: summed amounts and a representative country, year and
    municipality (the smallest non-null one, so that reruns agree)."""
    return df.groupBy(*keys).agg(*_sums(amounts), *[F.min(c).alias(c) for c in representatives])


def heavy_keys(df: DataFrame, keys: Sequence[str] = MERGE_KEYS, share: float = HEAVY_SHARE, tracked: int = 4_096) -> list[int]:
    """xxhash64 of the keys that hold at least ``share`` of all rows, and perhaps of some that hold a little less.

    One pass with a frequent-items sketch of ``tracked`` counters: a task sends its counters, not keys, and at most 1 / share
    numbers come back. The sketch counts too much or too little by at most 1 / ``tracked`` of the rows or so, which its threshold allows for.
    """
    most = max(1, int(1 / share))
    told = df.select(F.xxhash64(*keys).alias("key")).agg(
        F.expr(f"approx_top_k(key, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return sorted(t["item"] for t in told["top"] or [] if t["count"] >= (share - 2 / tracked) * told["n"])


def merge_payments_salted(
    df: DataFrame,
    salts: int = 10,
    keys: Sequence[str] = MERGE_KEYS,
    amounts: Sequence[str] = AMOUNT_COLUMNS,
    representatives: Sequence[str] = REPRESENTATIVES,
    heavy: Sequence[int] | None = None,
) -> DataFrame:
    """As ``merge_payments``, with the rows of heavy keys summed in ``salts`` sub-groups per key first; all other keys take the plain way.

    ``heavy`` are the keys' xxhash64 (see ``heavy_keys``, which is asked if there are none given); they change the plan, never the rows. A
    sub-group is a hash of the representatives: rows alike in them stay together, so that the first phase shrinks its input, and a retried task puts a
    row where the first attempt did. Without heavy keys this is the plain merge.
    """
    heavy = heavy_keys(df, keys) if heavy is None else list(heavy)
    if not heavy:
        return merge_payments(df, keys, amounts, representatives)
    among = F.xxhash64(*keys).isin(heavy)
    salt = F.pmod(F.xxhash64(*representatives), F.lit(salts)).alias("_salt")
    # Sums alone need no sorting; the smallest representatives are taken from what they leave.
    told = df.filter(among).groupBy(salt, *keys, *representatives).agg(*[F.sum(cents(F.col(c))).alias(c) for c in amounts])
    merged = told.groupBy(*keys).agg(
        *[(F.sum(c) / F.lit(100.0)).alias(c) for c in amounts], *[F.min(c).alias(c) for c in representatives]
    )
    return merge_payments(df.filter(~among), keys, amounts, representatives).union(merged)


def payout_totals(df: DataFrame) -> DataFrame:
    """Add the EU payout (both funds) and the public payout (EU plus national); NULL counts as 0."""
    eu = F.coalesce(F.col(EAGF), F.lit(0.0)) + F.coalesce(F.col(EAFRD), F.lit(0.0))
    public = eu + F.coalesce(F.col(COFUNDING), F.lit(0.0))
    return df.withColumns({EU_PAYOUT: eu, PUBLIC_PAYOUT: public}).fillna(
        0.0, [*AMOUNT_COLUMNS, EU_PAYOUT, PUBLIC_PAYOUT]
    )


def nonzero_payouts(df: DataFrame) -> DataFrame:
    return df.filter(F.col(PUBLIC_PAYOUT) != 0.0)


def identifiable_payouts(df: DataFrame) -> DataFrame:
    """Rows whose beneficiary is known."""
    return df.filter(F.col("beneficiary").isNotNull() & (F.col("beneficiary") != UNKNOWN_TEXT))


def distinct_schemes(df: DataFrame, missing_texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """The scheme labels in use, missing-value markers left out."""
    code = F.col("intervention_code")
    return df.select(code).filter(code.isNotNull() & ~code.isin(*missing_texts)).distinct()


def classify_schemes(
    df: DataFrame, schemes: Sequence[Scheme] = SCHEMES, code: str = "intervention_code", slug: str = SLUG
) -> DataFrame:
    """Add the slug, group and English name of each row's scheme. Labels match exactly; a missing
    or unlisted one gets the catch-all slug and no group."""
    known = taxonomy_frame(df.sparkSession, schemes).select(
        F.col("raw_code").alias("_label"), F.col("slug").alias("_slug"), "group_name", "english"
    )
    if len(schemes) <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return (
        df.join(known, F.col(code) == F.col("_label"), "left")
        .withColumn(slug, F.coalesce("_slug", F.lit(OTHER_SLUG)))
        .drop("_label", "_slug")
    )


def macro_totals(df: DataFrame) -> DataFrame:
    """Per beneficiary: both funds and the public payout."""
    return df.groupBy("beneficiary").agg(*_sums(MACRO_COLUMNS))


def scheme_pivot(df: DataFrame, schemes: Sequence[Scheme] = SCHEMES) -> DataFrame:
    """Per beneficiary, the public payout by scheme slug (0 where there is none); ``df`` is classified."""
    columns = slugs(schemes)
    wide = df.groupBy("beneficiary").pivot(SLUG, columns).agg(exact_sum(PUBLIC_PAYOUT))
    return wide.fillna(0.0, columns)


def beneficiary_master_join(df: DataFrame, schemes: Sequence[Scheme] = SCHEMES) -> DataFrame:
    """The master table as macro totals joined with the pivot. NULL beneficiaries have no match.

    ``beneficiary_master`` gives the same rows with one shuffle; this form is kept to compare.
    """
    return macro_totals(df).join(scheme_pivot(df, schemes), "beneficiary", "inner")


def beneficiary_master(df: DataFrame, schemes: Sequence[Scheme] = SCHEMES) -> DataFrame:
    """The wide master table of a classified frame: macro totals and one column per slug.

    All columns come from a single aggregation per beneficiary, hence a single shuffle. Amounts
    are put into cents once per row, ahead of the 38 sums. The slug columns of a partial row are
    mostly zero, which costs next to nothing once compressed.
    """
    in_cents = df.filter(F.col("beneficiary").isNotNull()).select(
        "beneficiary", SLUG, *[cents(F.col(c)).alias(c) for c in MACRO_COLUMNS]
    )
    payout = F.coalesce(F.col(PUBLIC_PAYOUT), F.lit(0.0))
    macros = {c: F.sum(c) for c in MACRO_COLUMNS}
    per_slug = {s: F.sum(F.when(F.col(SLUG) == s, payout).otherwise(F.lit(0.0))) for s in slugs(schemes)}
    return in_cents.groupBy("beneficiary").agg(
        *[(total / F.lit(100.0)).alias(name) for name, total in (macros | per_slug).items()]
    )


def group_totals(df: DataFrame) -> DataFrame:
    """Public payout per taxonomy group of a classified frame; unlisted schemes have no group."""
    return df.groupBy("group_name").agg(
        exact_sum(PUBLIC_PAYOUT).alias(PUBLIC_PAYOUT), F.count(F.lit(1)).alias("payments")
    )


def top_beneficiaries(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest public payouts, largest first; ties by name."""
    return macro_totals(df).orderBy(F.col(PUBLIC_PAYOUT).desc(), "beneficiary").limit(n)
