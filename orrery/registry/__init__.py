"""Query registry: each query next to the SQL that must give the same rows."""

from orrery.registry import cleaning, learning, row_order, scalar, storage  # noqa: F401
from orrery.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
