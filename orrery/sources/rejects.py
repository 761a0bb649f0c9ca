"""Counts and rows of what a load or a training set leaves out, taken in the pass that reads it.

Counts are observed metrics of the job that writes the first copy of the rows, so they cost no
pass of their own; the rejected values travel with that copy and become a side table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from orrery.functions.numbers import is_valid, parse_feature
from orrery.functions.text import has_text, strip
from orrery.operators.clean import NUMERIC_COLUMNS
from orrery.sources.delimited import column_values

#: Column with the rejected values of a row.
REJECTS = "_rejects"


@dataclass(frozen=True)
class ColumnCounts:
    """Rows read, and for each column how many values were missing and how many were no value of its type."""

    rows: int
    missing: dict[str, int]
    rejected: dict[str, int]


class Observed:
    """The counts of a DataFrame's first action; asking before that action has run would wait for it."""

    def __init__(self, names: list[str]):
        self.names, self.observation = names, Observation()

    def counts(self) -> ColumnCounts:
        told = self.observation.get
        pick = lambda kind: {c: int(told[f"{kind}:{c}"]) for c in self.names}
        return ColumnCounts(int(told["rows"]), pick("missing"), pick("rejected"))


def _observed(df: DataFrame, missing: dict[str, Column], rejected: dict[str, Column]) -> tuple[DataFrame, Observed]:
    seen = Observed(list(missing))
    counts = [F.count_if(missing[c]).alias(f"missing:{c}") for c in missing] + [F.count_if(rejected[c]).alias(f"rejected:{c}") for c in missing]
    return df.observe(seen.observation, F.count(F.lit(1)).alias("rows"), *counts), seen


def _listed(rejected: dict[str, Column], values: dict[str, Column]) -> Column:
    """The rejected values of a row as (column_name, value)."""
    each = [F.when(rejected[c], F.struct(F.lit(c).alias("column_name"), values[c].cast("string").alias("value"))) for c in rejected]
    return F.array_compact(F.array(*each))


def typed_observed(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observed]:
    """Text columns to the types of ``schema``, with rejected texts listed in ``_rejects`` and counted.

    A missing token is missing; any other text without a value of its column's type is rejected,
    and NULL in its column.
    """
    columns = column_values(schema)
    text, value = {c: pair[0] for c, pair in columns.items()}, {c: pair[1] for c, pair in columns.items()}
    missing = {c: text[c].isNull() for c in text}
    rejected = {c: text[c].isNotNull() & value[c].isNull() for c in text}
    seen, counts = _observed(df, missing, rejected)
    return seen.select(*[value[c].alias(c) for c in value], _listed(rejected, text).alias(REJECTS)), counts


def reject_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, column_name, value): one row per rejected value of a copy that carries ``_rejects``."""
    return df.filter(F.size(REJECTS) > 0).select(key, F.explode(REJECTS).alias("r")).select(key, "r.column_name", "r.value")


def features_observed(
    df: DataFrame, features: Iterable[str] = NUMERIC_COLUMNS, label: str = "subpopulation"
) -> tuple[DataFrame, Observed]:
    """Rows of a labelled data set with the values that make a row incomplete counted and listed.

    A blank label, an empty or ``nan`` feature is missing; a text feature that spells no number
    is rejected. A column that the input lacks is missing in every row.
    """
    have = {c: F.col(c) for c in df.columns}
    missing, rejected = {label: ~has_text(have[label]) if label in have else F.lit(True)}, {label: F.lit(False)}
    for c in features:
        if c not in have:
            missing[c], rejected[c] = F.lit(True), F.lit(False)
        elif isinstance(df.schema[c].dataType, T.StringType):
            spelled = strip(have[c])
            empty = F.coalesce((spelled == "") | (F.lower(spelled) == "nan"), F.lit(True))
            missing[c], rejected[c] = empty, ~empty & parse_feature(have[c]).isNull()
        else:
            missing[c], rejected[c] = ~F.coalesce(is_valid(have[c]), F.lit(False)), F.lit(False)
    seen, counts = _observed(df, missing, rejected)
    # Whatever drops the row is listed; a missing value without its text.
    wrong = {c: missing[c] | rejected[c] for c in missing}
    shown = {c: F.when(rejected[c], have[c]) if c in have else F.lit(None).cast("string") for c in missing}
    return seen.withColumn(REJECTS, _listed(wrong, shown)), counts
