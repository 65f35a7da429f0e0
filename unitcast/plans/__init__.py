"""Named queries composed from the operators, with DuckDB oracle SQL."""

from unitcast.plans import basic, flows, frames, incrementalq, modelq, panelq, solveq, textual  # noqa: F401  (registers queries)
from unitcast.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
