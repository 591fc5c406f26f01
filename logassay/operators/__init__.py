"""Audit operators: contract, profile, quality, coverage, calendar, duplicates, verdicts."""
