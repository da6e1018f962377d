"""Queries of the engine and their SQL, by name."""

from __future__ import annotations

from voxloom.plans import calls, more, ops, runs, spans, text  # noqa: F401  registers its queries
from voxloom.plans.base import ORACLES, QUERIES

FLAGSHIP = "CN-COMPUTE"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
