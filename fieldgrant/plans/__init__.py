"""Whole runs: landing to bronze, bronze to silver, silver to the master table, and the run ledger."""
