"""Spark toolkit that turns landed payment files into trusted, analysis-ready tables."""

from .catalog import active_sources, catalog
from .plans.bronze import RunOutcome, run_bronze, run_catalog
from .plans.ledger import Ledger
from .plans.master import build_master
from .plans.silver import run_registry, run_silver
from .spec import DATASETS, SILVER_SCHEMA, DatasetSpec, FieldSpec, payment_fields
from .taxonomy import SCHEMES, Scheme

__all__ = [
    "DATASETS",
    "DatasetSpec",
    "FieldSpec",
    "Ledger",
    "RunOutcome",
    "SCHEMES",
    "SILVER_SCHEMA",
    "Scheme",
    "active_sources",
    "build_master",
    "catalog",
    "payment_fields",
    "run_bronze",
    "run_catalog",
    "run_registry",
    "run_silver",
]
