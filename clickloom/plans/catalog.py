"""All registered queries and their SQL twins."""

from __future__ import annotations

from clickloom.plans import queries_data, queries_mart, queries_models  # noqa: F401
from clickloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
