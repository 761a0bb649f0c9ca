"""Predictions for every picture of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orrery.operators.images import image_predictions
from orrery.sinks.files import write_image_predictions
from orrery.sources.image_files import read_images


def predict_folder(
    spark: SparkSession, folder: str, load: Callable, output: str, height: int = 256, width: int = 320,
    pattern: str = "*.[pP][nN][gG]", method: str = "bicubic",
) -> DataFrame:
    """(origin, x_px, y_px) of all PNG files, written as parquet. ``load`` returns the model's predict function."""
    pictures = read_images(spark, folder, pattern)
    write_image_predictions(image_predictions(pictures, load, height, width, method=method), output)
    return spark.read.parquet(output)
