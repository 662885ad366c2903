"""Named queries over the tables and their equivalents in DuckDB's SQL."""

from __future__ import annotations

from palimpsest.plans import evidence, graph, merges, scalars, search
from palimpsest.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "evidence", "graph", "merges", "scalars", "search"]
