"""Category frequencies, the two label encodings, one-hot rows and feature arrays."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from orrery.operators.clean import NUMERIC_COLUMNS
from orrery.operators.joins import lookup_join
from orrery.operators.rows import rank_distinct
from orrery.runtime import freeze


def category_frequency(df: DataFrame, column: str) -> DataFrame:
    """(category, n, idx): most frequent first, ties in alphabetical order.

    Counting combines on the map side, so a dominant category costs one row per
    task in the shuffle.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col(column).asc()]
    return rank_distinct(freeze(counts, "categories"), order, [column, "n"], "idx")


def string_index(df: DataFrame, column: str, output: str = "idx", categories: DataFrame | None = None) -> DataFrame:
    """Index by descending frequency; values outside the categories get the next free index."""
    categories = category_frequency(df, column) if categories is None else categories
    known = categories.select(column, F.col("idx").cast("double").alias(output))
    unseen = categories.agg(F.coalesce(F.max("idx") + 1, F.lit(0)).cast("double").alias("i")).first()["i"]
    indexed = lookup_join(df, known, column, "left")
    return indexed.withColumn(output, F.coalesce(F.col(output), F.lit(unseen)))


def one_hot_rows(df: DataFrame, index: str, labels: int, keep: Iterable[str]) -> DataFrame:
    """One-hot vectors in long form: only the slots that are set.

    The slot of unseen values is dropped, so such a row has no set slot.
    """
    return df.filter(F.col(index) < labels).select(
        *keep, F.col(index).cast("int").alias("slot"), F.lit(1.0).alias("value")
    )


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).select(label).distinct().orderBy(label)


def vocabulary(df: DataFrame, label: str, output: str = "idx") -> DataFrame:
    """(label, index): distinct labels numbered in code-point order."""
    labels = freeze(df.filter(F.col(label).isNotNull()).select(label).distinct(), "labels")
    ranked = rank_distinct(labels, [F.col(label)], [label], output)
    return ranked.withColumn(output, F.col(output).cast("int"))


def label_encode(
    df: DataFrame, label: str, output: str = "label_idx", vocab: DataFrame | None = None
) -> DataFrame:
    """Attach the label's place in the sorted vocabulary."""
    vocab = vocabulary(df, label, output) if vocab is None else vocab
    return lookup_join(df, vocab.select(label, output), label)


def num_classes(encoded: DataFrame, index: str = "label_idx") -> DataFrame:
    return encoded.agg((F.max(index) + 1).cast("bigint").alias("num_classes"))


def feature_array(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS, output: str = "x") -> DataFrame:
    """Numeric columns as one float32 array per row."""
    return df.withColumn(output, F.array(*[F.col(c).cast("float") for c in columns]))


def feature_vector(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """An array column as an ML vector."""
    return df.withColumn(output, array_to_vector(F.col(column)))
