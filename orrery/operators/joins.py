"""Equi-joins of a large left side with a lookup side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orrery.runtime import fits_broadcast


def lookup_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", broadcast_ok: bool | None = None) -> DataFrame:
    """Join a large left side with a lookup side (``inner``, ``left``, ``left_semi``, ``left_anti``).

    The right side is broadcast when it is small: by the size in its plan where that is
    clear, by measuring it where it is not. Otherwise both sides shuffle, and adaptive
    execution splits the reducers of frequent left keys by the bytes it sees. NULL keys
    match nothing and never travel.
    """
    if broadcast_ok is None:
        broadcast_ok = fits_broadcast(right)
    if broadcast_ok:
        return left.join(F.broadcast(right), on, how)
    if how in ("left_semi", "left_anti"):
        # Only presence counts; one row per key keeps a frequent right key harmless.
        right = right.select(on).distinct()
    key = F.col(on)
    joined = left.filter(key.isNotNull()).join(right, on, how)
    if how in ("left", "left_anti"):
        joined = joined.unionByName(left.filter(key.isNull()), allowMissingColumns=True)
    return joined


def keep_existing(records: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Records whose key occurs in ``listing``."""
    return lookup_join(records, listing.select(key), key, "left_semi")


def report_missing(records: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Both complements: labelled but not listed, and listed but not labelled."""
    unlisted = lookup_join(records, listing.select(key), key, "left_anti").select(
        key, F.lit("labelled_not_listed").alias("reason")
    )
    unlabelled = lookup_join(listing, records.select(key), key, "left_anti").select(
        key, F.lit("listed_not_labelled").alias("reason")
    )
    return unlisted.unionByName(unlabelled)
