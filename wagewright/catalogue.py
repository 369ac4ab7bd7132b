"""Loads every module that registers queries."""

from wagewright.plans import (  # noqa: F401
    aggregates,
    payroll,
    quality,
    relational,
    reports,
    scalars,
    snapshots,
    streams,
    upkeep,
    warehouse,
    windows,
)
from wagewright.registry import REGISTRY

__all__ = ["REGISTRY"]
