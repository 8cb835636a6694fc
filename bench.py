"""Time the headline queries: warm, median of five, one JSON line on stdout.

``queries`` are registered queries end to end, joins that build their input included. ``steps``
run on a bronze table written beforehand and show what an operator costs by itself; ``ratios``
set them against the form they replace. ``calibration`` is a fixed step that tells machines apart.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgrant.operators import payments, profile, quality, shape
from fieldgrant.plans import master
from fieldgrant.registered import QUERIES, fixtures
from fieldgrant.sources.scratch import materialise
from fieldgrant.spec import AMOUNT_COLUMNS, TEXT_COLUMNS

HEADLINES = (
    "silver",
    "merge_payments",
    "merge_salted",
    "beneficiary_master",
    "beneficiary_master_join",
    "missing_profile",
    "distinct_profile",
    "quality_report",
    "quality_prefill",
    "duplicate_grain",
    "classify_published",
    "top_beneficiaries",
    "scheme_pivot",
    "ledger_current",
    "page_links",
    "first_matching_link",
    "dataset_fingerprint",
)
WARM_UPS = 2
RUNS = 5
#: Whole runs write files, so they are timed fewer times.
WHOLE = ("bronze_run", "silver_run", "master_run", "bronze_stream")


def seconds(build, warm_ups: int = WARM_UPS, runs: int = RUNS) -> float:
    """Median time to compute every row of a query, after warm-ups."""
    times = []
    for _ in range(warm_ups + runs):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[warm_ups:]), 4)


def separate_checks(silver: DataFrame) -> None:
    """The quality rules as a job each, the form the one-pass report replaces."""
    silver.limit(1).count()
    for c in TEXT_COLUMNS:
        silver.filter(F.col(c) == "").limit(1).count()
    for c in AMOUNT_COLUMNS:
        silver.filter(F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))).limit(1).count()


def timed(action) -> float:
    times = []
    for _ in range(WARM_UPS + RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[WARM_UPS:]), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldgrant-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        # The larger joins shuffle, as they would at scale, instead of running in the one task
        # that a single-row-group file gives.
        .config("spark.sql.autoBroadcastJoinThreshold", "400KB")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The same work in every round, whatever the code: machines of different rounds can be compared by it.
    calibration = seconds(lambda: spark.range(100_000_000).agg(F.sum(F.xxhash64("id") % 1000).alias("s")))
    queries = {name: seconds(lambda: QUERIES[name](spark, sf_dir)) for name in HEADLINES}
    queries |= {name: seconds(lambda: QUERIES[name](spark, sf_dir), 1, 3) for name in WHOLE}

    bronze = materialise(fixtures.bronze(spark, sf_dir, labels=True).repartition(int(cpus)), "bench-bronze")
    silver = materialise(shape.to_silver(bronze, fixtures.SPAIN), "bench-silver")
    unstored = shape.to_silver(bronze, fixtures.SPAIN)
    # One beneficiary and scheme holds a third of the rows, in many municipalities.
    hot = F.pmod(F.xxhash64(*silver.columns), F.lit(3)) == 0
    skewed = silver.withColumns(
        {c: F.when(hot, F.lit("hot")).otherwise(F.col(c)) for c in ("beneficiary", "intervention_code")}
    )
    skewed = materialise(skewed, "bench-skewed")
    mapped = shape.map_columns(bronze, fixtures.SPAIN)
    everything = (*TEXT_COLUMNS, *AMOUNT_COLUMNS)
    steps = {
        "scan_aggregate": seconds(lambda: mapped.agg(*[F.count(c).alias(c) for c in mapped.columns])),
        "missing_profile": seconds(lambda: profile.missing_profile(bronze)),
        "quality_one_pass": seconds(lambda: quality.quality_report(mapped, everything, AMOUNT_COLUMNS)),
        "quality_separate_jobs": timed(lambda: separate_checks(silver)),
        "silver_unguarded": seconds(lambda: unstored),
        "silver_guarded": seconds(lambda: quality.guard(unstored)),
        "merge_plain": seconds(lambda: payments.merge_payments(silver)),
        "merge_salted": seconds(lambda: payments.merge_payments_salted(silver)),
        "merge_plain_skewed": seconds(lambda: payments.merge_payments(skewed)),
        "merge_salted_skewed": seconds(lambda: payments.merge_payments_salted(skewed)),
        "heavy_keys": timed(lambda: payments.heavy_keys(silver)),
        "master_fused": seconds(lambda: master.build_master(silver)),
        "master_join": seconds(lambda: master.build_master_join(silver)),
    }
    ratios = {
        "master_fused/join": steps["master_fused"] / steps["master_join"],
        "merge_salted/plain": steps["merge_salted"] / steps["merge_plain"],
        "merge_salted/plain_skewed": steps["merge_salted_skewed"] / steps["merge_plain_skewed"],
        "quality_one_pass/scan_aggregate": steps["quality_one_pass"] / steps["scan_aggregate"],
        "quality_one_pass/separate_jobs": steps["quality_one_pass"] / steps["quality_separate_jobs"],
        "silver_guarded/unguarded": steps["silver_guarded"] / steps["silver_unguarded"],
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "steps": steps,
                "ratios": {k: round(v, 3) for k, v in ratios.items()},
                "calibration": calibration,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
