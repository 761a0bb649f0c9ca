"""Time functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def run_id(ts: Column | None = None) -> Column:
    """Run identifier such as 20240131_235912."""
    return F.date_format(F.current_timestamp() if ts is None else ts, "yyyyMMdd_HHmmss")
