"""All registered queries."""

from __future__ import annotations

from alarmloom.plans import catalog_points, catalog_rules, catalog_time  # noqa: F401
from alarmloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
