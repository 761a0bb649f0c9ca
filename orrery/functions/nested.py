"""JSON, array and map functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def argmax(values: Column) -> Column:
    """Zero-based place of the first largest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def scale_pixels(values: Column) -> Column:
    return F.transform(values, lambda v: (v / F.lit(255)).cast("float"))


def json_field(document: Column, path: str) -> Column:
    return F.get_json_object(document, f"$.{path}")


def label_map_json(index: Column, label: Column) -> Column:
    """Aggregate of (index, label) rows into one ``{index: label}`` JSON object."""
    entries = F.array_sort(F.collect_list(F.struct(index.alias("key"), label.alias("value"))))
    return F.to_json(F.map_from_entries(entries))
