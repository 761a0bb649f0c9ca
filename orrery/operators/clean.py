"""Missing-value profiling, the three row policies and mean imputation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from orrery.functions.numbers import is_valid, parse_feature, valid_or_null
from orrery.functions.text import has_text, strip

# Columns of a health file that are numbers, and those that a load inserts.
NUMERIC_COLUMNS = ["value", "lower_ci", "upper_ci"]
INSERT_COLUMNS = [
    "edition", "report_type", "measure_name", "state_name", "subpopulation",
    "value", "lower_ci", "upper_ci", "source", "source_date",
]


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The listed columns that the input has, decided from the schema alone."""
    return [c for c in columns if c in df.columns]


def rows_missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def rows_present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def rows_valid(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_valid(F.col(column)))


def rows_labelled(df: DataFrame, label: str) -> DataFrame:
    """Drop rows whose label is NULL or blank; the label comes out trimmed."""
    return df.filter(has_text(F.col(label))).withColumn(label, strip(F.col(label)))


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row: row count and NULL count of every column, in a single pass."""
    names = list(columns or df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in names],
    )


def mean_valid(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """One row: mean of every column without NULL and NaN, in a single pass.

    Columns are named in a list; one name by itself, or no listed column in the input, is an error.
    """
    names = present(df, [columns] if isinstance(columns, str) else columns)
    if isinstance(columns, str) or not names:
        raise ValueError(f"mean_valid needs a list with columns of the input, not {columns!r}")
    return df.agg(*[F.avg(valid_or_null(F.col(c))).alias(f"{c}_mean") for c in names])


def fill_missing(df: DataFrame, means: dict[str, float | None]) -> DataFrame:
    """Replace NULL and NaN by the given values; other columns stay as they are."""
    filled = {
        c: F.when(F.col(c).isNull() | F.isnan(c), F.lit(mean).cast("double")).otherwise(F.col(c))
        for c, mean in means.items()
    }
    return df.withColumns(filled) if filled else df


def impute_mean(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Mean imputation of the listed columns that exist; an all-missing column stays NULL."""
    names = present(df, columns)
    if not names:
        return df
    means = mean_valid(df, names).first()
    return fill_missing(df, {c: means[f"{c}_mean"] for c in names})


def numbers_from_text(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Parse those of the listed columns that are text, as after a type inference that met ``NA``."""
    texts = [c for c in present(df, columns) if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: parse_feature(F.col(c)) for c in texts}) if texts else df


def complete_cases(
    df: DataFrame, features: Iterable[str] = NUMERIC_COLUMNS, label: str = "subpopulation"
) -> DataFrame:
    """Rows with a label and a number in every feature.

    Text features are parsed on the way. A feature or label column that the
    input lacks makes every row incomplete.
    """
    names = list(features)
    if label not in df.columns or any(c not in df.columns for c in names):
        return df.limit(0)
    kept = F.lit(True)
    for c in names:
        parsed = isinstance(df.schema[c].dataType, T.StringType)
        kept = kept & (F.col(c).isNotNull() if parsed else is_valid(F.col(c)))
    return numbers_from_text(rows_labelled(df, label), names).filter(kept)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise when ``df`` is empty; reads no further than the first row found."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def project(df: DataFrame, columns: Iterable[str] = INSERT_COLUMNS) -> DataFrame:
    """Columns by name and in the given order."""
    return df.select(*columns)


def column_profile(df: DataFrame) -> DataFrame:
    """Schema with NULL counts: one row per column."""
    counts = null_profile(df)
    pairs = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"{f.name}_nulls").alias("nulls"))
        for f in df.schema.fields
    ])
    return counts.select("n_rows", F.explode(pairs).alias("c")).select(
        "c.column_name", "c.data_type", "c.nulls", "n_rows"
    )
