"""Landing to bronze, one dataset at a time."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..catalog import active_sources
from ..functions.names import quoted
from ..operators.shape import stamp_provenance
from ..sources.landing import dataset_inventory, landed_paths, landing_fingerprint
from ..sources.readers import BROKEN, read_landed
from ..sources.sinks import replace_bronze
from .ledger import Ledger

STAGE = "BRONZE"

SKIPPED = "skipped"
EMPTY = "empty"


@dataclass(frozen=True)
class RunOutcome:
    dataset_id: str
    status: str
    reason: str | None = None


def run_bronze(
    spark: SparkSession,
    landing_root: str,
    bronze_path: str,
    ledger: Ledger,
    country: str,
    year: str,
    delimiter: str = ";",
    encoding: str | None = None,
    same_header: bool = False,
    at: Column | None = None,
    json_lines: bool | None = None,
) -> RunOutcome:
    """Bring the landed files of one dataset into the bronze table.

    Skipped when the ledger has a processed record for the same set of files. A failure is
    recorded with its reason and reported, not raised, so that other datasets still run. Landed data files
    that can't be scanned (spreadsheets, say) are named in the outcome and the ledger; JSON text that is no record is left out, and
    counted in both.
    """
    dataset_id = f"{country.upper()}_{year}"
    fingerprint = None
    try:
        landed = dataset_inventory(spark, landing_root, country, year)
        files, others = ([], []) if landed is None else landed_paths(landed)
        unread = ", ".join(p.rsplit("/", 1)[-1] for p in others)
        if not files:
            return RunOutcome(dataset_id, EMPTY, f"not scannable: {unread}" if unread else "no landed files")
        fingerprint = landing_fingerprint(landed, f"{year}_LANDING").first().fingerprint
        if ledger.is_processed(STAGE, country, year, fingerprint):
            return RunOutcome(dataset_id, SKIPPED)
        rows = read_landed(spark, files, delimiter, encoding, same_header, json_lines)
        broken = None
        if BROKEN in rows.columns:
            broken = Observation()
            text = F.col(quoted(BROKEN))
            rows = rows.observe(broken, F.count(text).alias("pieces"), F.min(text).alias("example")).filter(text.isNull()).drop(BROKEN)
        count = replace_bronze(stamp_provenance(rows, country, year, at), bronze_path, country, year)
    except Exception as e:
        ledger.mark_failed(STAGE, country, year, str(e), fingerprint, {"error_type": type(e).__name__})
        return RunOutcome(dataset_id, "failed", str(e))
    metadata = {"files": len(files), "rows": count} | ({"unread": unread} if unread else {})
    reasons = [f"not scannable: {unread}"] if unread else []
    if broken and (pieces := broken.get["pieces"]):
        metadata |= {"broken": pieces, "broken_example": broken.get["example"].strip("\x01 ")[:200]}
        reasons.append(f"{pieces} broken JSON pieces")
    ledger.mark_processed(STAGE, country, year, fingerprint, metadata)
    return RunOutcome(dataset_id, "processed", "; ".join(reasons) or None)


def run_catalog(
    spark: SparkSession, sources: DataFrame, landing_root: str, bronze_path: str, ledger: Ledger
) -> Iterable[RunOutcome]:
    """Run every active source of a catalog (one row per dataset), in catalog order. Optional columns
    ``same_header`` and ``json_lines`` are passed on; a source said to have no header fails."""
    for s in active_sources(sources).toLocalIterator():
        known = s.asDict()
        if known.get("has_header") is False:
            reason = "files without a header have no column names to map"
            ledger.mark_failed(STAGE, s.country, s.year, reason)
            yield RunOutcome(f"{s.country.upper()}_{s.year}", "failed", reason)
            continue
        yield run_bronze(
            spark, landing_root, bronze_path, ledger, s.country, s.year, s.delimiter or ";", s.encoding,
            same_header=bool(known.get("same_header")), json_lines=known.get("json_lines"),
        )
