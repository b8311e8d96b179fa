"""Queries that show every operator on the test tables, each with the same result in plain SQL."""

from acceptance.registry import ORACLES, QUERIES
from acceptance import audit, extraction, jdbc, loading, planning, projection, sql_text  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
