"""File outputs: dataset copies, label maps, histories, image predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orrery.functions.nested import label_map_json


def copy_dataset(df: DataFrame, uri: str, kind: str = "parquet") -> None:
    """Write a dataset to a store that Spark reaches by URI, in parallel."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer = writer.options(header=True, escape='"')
    writer.format(kind).save(uri)


def write_label_map(vocab: DataFrame, label: str, index: str, path: str) -> None:
    """One JSON object ``{index: label}`` at every size: one row, as large as the vocabulary
    that a classifier holds in any case."""
    pairs = vocab.select(F.col(index).alias("index"), F.col(label).alias("label"))
    document = label_map_json(F.col("index").cast("string"), F.col("label")).alias("value")
    pairs.agg(document).coalesce(1).write.mode("overwrite").text(path)


def write_history(history: DataFrame, path: str) -> None:
    """(epoch, metric, value) rows as JSON lines."""
    history.write.mode("overwrite").json(path)


def write_history_arrays(wide: DataFrame, epoch: str, metrics: list[str], path: str) -> None:
    """One JSON object with an array per metric, in epoch order; one value per epoch."""
    in_order = F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("_at"), *metrics)))
    arrays = wide.agg(in_order.alias("rows"))
    arrays.select(*[F.col("rows")[m].alias(m) for m in metrics]).coalesce(1).write.mode("overwrite").json(path)


def write_image_predictions(predictions: DataFrame, path: str) -> None:
    predictions.select("origin", "x_px", "y_px").write.mode("overwrite").parquet(path)
