"""Snapshot diff, contract checks, expectations, drift, ranking, matching, reports."""
