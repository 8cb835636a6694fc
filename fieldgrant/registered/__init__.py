"""The queries registered with the driver, each with the SQL that must give the same rows."""

from __future__ import annotations

from . import lakes, payouts, reports, runs, scans, shaping

MODULES = (scans, shaping, reports, payouts, runs, lakes)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
