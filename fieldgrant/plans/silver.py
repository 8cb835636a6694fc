"""Bronze to silver, one dataset at a time."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.amounts import parse_failed
from ..functions.names import quoted
from ..operators.profile import grain_key, repeated_grain
from ..operators.quality import GUARD_MARK, QualityViolation, enforce_schema, guard
from ..operators.shape import fill_missing, stamp_silver
from ..sources.scratch import materialise
from ..sources.sinks import SILVER_PARTITIONS, read_bronze_dataset, write_silver
from ..spec import DATASETS, SILVER_SCHEMA, DatasetSpec
from . import bronze
from .bronze import SKIPPED, RunOutcome
from .ledger import Ledger

STAGE = "SILVER"


_RAW = "raw_"


def _mapped_with_raw(prepared: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The mapped columns before any fill, and beside each parsed one the text it came from."""
    raw = [
        F.col(quoted(field.present_source(prepared.columns))).alias(_RAW + field.target)
        for field in spec.fields
        if field.parse is not None
    ]
    return prepared.select(*[field.expression(prepared.columns) for field in spec.fields], *raw)


def intake_metrics(spec: DatasetSpec) -> list[Column]:
    """Aggregates over mapped columns: rows, missing values per column, and values given that did
    not parse. After the fills nobody can tell these from true zeros."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    for field in spec.fields:
        value = F.col(field.target)
        metrics.append(F.count_if(value.isNull()).alias(f"missing_{field.target}"))
        if field.parse is not None:
            metrics.append(F.count_if(parse_failed(_RAW + field.target, value)).alias(f"unparsed_{field.target}"))
    return metrics


def intake_report(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The intake metrics as rows: (metric, value)."""
    prepared = df if spec.prepare is None else df.transform(spec.prepare)
    counted = _mapped_with_raw(prepared, spec).agg(*intake_metrics(spec))
    rows = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in counted.columns]
    return counted.select(F.inline(F.array(*rows)))


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    ledger: Ledger,
    spec: DatasetSpec,
    at: Column | None = None,
    unique_grain: bool = False,
    exact_grain: bool = True,
) -> RunOutcome:
    """Bring one bronze dataset into the silver table.

    Reads bronze once: parsing, intake metrics, quality rules, a sketch of the distinct grain values and the write are one job, and a
    broken rule fails that job before it commits. Skipped while the bronze fingerprint is unchanged; data without a
    fingerprint is never taken for done. Columns beyond the contract that the spec names are kept after it.

    The ledger tells how many grain values have more than one row, counted over the grain columns of what was written;
    ``exact_grain=False`` saves that and leaves the sketch's number of distinct values (``grain_estimate``, 2% off or so). With ``unique_grain`` a
    repeated value is a broken rule: rows are then written to the scratch folder, counted there, and copied to silver if there is none.
    """
    country, year = spec.country, spec.year
    fingerprint = None
    try:
        # What bronze holds is its latest processed run, even if one has failed since.
        fingerprint = ledger.latest_processed(bronze.STAGE, country, year)
        if fingerprint is not None and ledger.is_processed(STAGE, country, year, fingerprint):
            return RunOutcome(spec.dataset_id, SKIPPED)
        raw = read_bronze_dataset(spark, bronze_path, country, year)
        prepared = raw if spec.prepare is None else raw.transform(spec.prepare)
        intake, distinct = Observation(), Observation()
        silver = (
            _mapped_with_raw(prepared, spec)
            .observe(intake, *intake_metrics(spec))
            .select(*[field.target for field in spec.fields])
            .transform(fill_missing)
            .transform(stamp_silver, at)
        )
        extra = [f.target for f in spec.fields if f.target not in SILVER_SCHEMA.names]
        silver = silver.select(*[c for c in SILVER_SCHEMA.names if c in silver.columns], *extra)
        checked = guard(enforce_schema(silver, spec.contract(silver.schema)))
        checked = checked.observe(distinct, F.approx_count_distinct(grain_key(checked, spec.grain), 0.02).alias("grain_estimate"))
        staged = materialise(checked, "silver") if unique_grain else checked
        if not unique_grain:
            write_silver(checked, silver_path)  # without rows this replaces nothing
        metrics = intake.get | distinct.get
        if not metrics["rows"]:
            raise QualityViolation("not_empty")
        if unique_grain or exact_grain:
            # One dataset is one value of these columns.
            grain = [c for c in spec.grain if c not in SILVER_PARTITIONS] or list(spec.grain)
            written = staged if unique_grain else spark.read.schema(checked.schema).parquet(f"{silver_path}/country={country}/year={year}")
            metrics |= {"repeated_grain": repeated_grain(written, grain).count()}
        if unique_grain:
            if metrics["repeated_grain"]:
                raise QualityViolation(f"unique grain: {metrics['repeated_grain']} repeated")
            write_silver(staged, silver_path)
    except Exception as e:
        broken = re.search(re.escape(GUARD_MARK) + "[^;]+", str(e))
        reason = broken.group(0) if broken else str(e)
        kind = QualityViolation.__name__ if broken else type(e).__name__
        ledger.mark_failed(STAGE, country, year, reason, fingerprint, {"error_type": kind})
        return RunOutcome(spec.dataset_id, "failed", reason)
    ledger.mark_processed(STAGE, country, year, fingerprint, metrics)
    return RunOutcome(spec.dataset_id, "processed")


def run_registry(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    ledger: Ledger,
    specs: Iterable[DatasetSpec] = tuple(DATASETS.values()),
) -> Iterable[RunOutcome]:
    """Run every registered dataset; one that fails does not stop the others."""
    for spec in specs:
        yield run_silver(spark, bronze_path, silver_path, ledger, spec)
