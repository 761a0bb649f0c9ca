"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orrery.functions.text import IMAGE_EXTENSIONS
from orrery.plans.health_view import HEALTH_VIEW_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def over_health(body: str) -> str:
    """SQL over the health rows as ``hv``; a body may start with ``,`` and further CTEs."""
    return f"WITH hv AS ({HEALTH_VIEW_SQL})\n{body}"


# The hv rows with a category, numbers imputed, as the ``clean`` table of an oracle.
IMPUTED_SQL = """
present AS (
  SELECT * FROM hv WHERE measure_name IS NOT NULL
), means AS (
  SELECT avg(CASE WHEN NOT isnan(value) THEN value END) AS m_value,
         avg(lower_ci) AS m_lower, avg(upper_ci) AS m_upper FROM present
), clean AS (
  SELECT p.id, p.measure_name, p.subpopulation,
         CASE WHEN p.value IS NULL OR isnan(p.value) THEN m.m_value ELSE p.value END AS value,
         coalesce(p.lower_ci, m.m_lower) AS lower_ci, coalesce(p.upper_ci, m.m_upper) AS upper_ci
  FROM present p CROSS JOIN means m
), ranks AS (
  SELECT measure_name, row_number() OVER (ORDER BY count(*) DESC, measure_name) - 1 AS idx
  FROM present GROUP BY measure_name
)
"""

EXTENSION_LIST_SQL = ", ".join(f"'{e}'" for e in IMAGE_EXTENSIONS)
