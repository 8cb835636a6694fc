"""The beneficiary master table kept up to date as datasets are replaced."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.amounts import cents
from ..operators import payments
from ..sources.snapshots import Snapshots
from ..spec import AMOUNT_COLUMNS
from ..taxonomy import SCHEMES, Scheme, slugs

_KEYS = payments.MERGE_KEYS
#: Amounts in cents, and the number of payments behind them, by which a key is known to be gone.
_STATE = ", ".join(f"{k} string" for k in _KEYS) + ", " + ", ".join(f"{c} double" for c in AMOUNT_COLUMNS) + ", payments long"


class MasterTable:
    """The master table of several datasets below ``path``.

    Kept are each dataset's contribution (payments summed in cents by beneficiary and scheme), the totals over all datasets, and the wide
    table. Replacing a dataset reads its new rows and its old contribution, adds their difference to the totals, and computes anew the
    beneficiaries that differ; all other datasets' rows are left alone. Whole cents add and subtract exactly (see
    ``exact_sum``), so the table equals one built from scratch. Each replacement is published as a whole: until then,
    and if it fails, readers see the one before. One replacement at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schemes: Sequence[Scheme] = SCHEMES):
        self.spark, self.path, self.schemes = spark, path, schemes
        self.snapshots = Snapshots(spark, path)
        wide = [*payments.MACRO_COLUMNS, *slugs(schemes)]
        self._wide = "beneficiary string, " + ", ".join(f"{c} double" for c in wide)

    def _contribution(self, silver: DataFrame) -> str:
        """Write a dataset's contribution; gives its folder."""
        rows = payments.identifiable_payouts(silver)
        sums = [F.coalesce(F.sum(cents(F.col(c))), F.lit(0.0)).alias(c) for c in AMOUNT_COLUMNS]
        folder = f"{self.path}/contributions/{uuid.uuid4().hex}"
        rows.groupBy(*_KEYS).agg(*sums, F.count(F.lit(1)).alias("payments")).write.parquet(folder)
        return folder

    def _added(self, *parts: DataFrame) -> DataFrame:
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole.groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in (*AMOUNT_COLUMNS, "payments")])

    def _state(self, folder: str) -> DataFrame:
        return self.spark.read.schema(_STATE).parquet(folder)

    def datasets(self) -> dict[str, str]:
        """The datasets that the table holds, with the folders of their contributions."""
        held = self.snapshots.read("dataset string, folder string", "datasets")
        return {} if held is None else {r["dataset"]: r["folder"] for r in held.collect()}

    def replace(self, dataset: str, silver: DataFrame | None) -> None:
        """Put ``silver`` in place of all rows that ``dataset`` had; None takes the dataset out."""
        spark, current, folders = self.spark, self.snapshots.version(), self.datasets()
        signed = []
        if old := folders.pop(dataset, None):
            less = [(-F.col(c)).alias(c) for c in (*AMOUNT_COLUMNS, "payments")]
            signed.append(self._state(old).select(*_KEYS, *less))
        if silver is not None:
            folders[dataset] = self._contribution(silver)
            signed.append(self._state(folders[dataset]))
        if not signed:
            return
        differs = F.greatest(*[F.abs(F.col(c)) for c in (*AMOUNT_COLUMNS, "payments")]) != 0
        version = uuid.uuid4().hex
        if len(signed) == 1:  # a contribution has each key once, and is stored
            delta = signed[0].filter(differs)
        else:
            self.snapshots.write(self._added(*signed).filter(differs), version=version, name="delta")
            delta = self.snapshots.read(_STATE, "delta", version)
        totals = delta if current is None else self._added(delta, self.snapshots.read(_STATE, "totals", current))
        self.snapshots.write(totals.filter("payments <> 0"), version=version, name="totals")

        rows = self.snapshots.read(_STATE, "totals", version)
        affected = delta.select("beneficiary").distinct()
        if current is not None:  # else all are
            rows = rows.join(affected, "beneficiary", "left_semi")
        rows = rows.withColumns({c: F.col(c) / F.lit(100.0) for c in AMOUNT_COLUMNS})
        for step in (payments.payout_totals, payments.nonzero_payouts):
            rows = step(rows)
        master = payments.beneficiary_master(payments.classify_schemes(rows, self.schemes), self.schemes)
        if current is not None:
            kept = self.snapshots.read(self._wide, "master", current).join(affected, "beneficiary", "left_anti")
            master = master.unionByName(kept)
        self.snapshots.write(master, version=version, name="master")
        listed = spark.createDataFrame(sorted(folders.items()), "dataset string, folder string")
        self.snapshots.write(listed, version=version, name="datasets")
        self.snapshots.publish(version)

    def master(self) -> DataFrame:
        """The wide table, as ``build_master`` gives it for all rows of all datasets; without rows before the first replacement."""
        held = self.snapshots.read(self._wide, "master")
        return self.spark.createDataFrame([], self._wide) if held is None else held
