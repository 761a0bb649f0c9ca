"""Dataset locations."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def data_path(name: str = "health.csv", project: str | None = None) -> str:
    """Object-store URI of a dataset of the project named by ``GCP_PROJECT_ID``."""
    project = project or os.environ.get("GCP_PROJECT_ID")
    if not project:
        raise ValueError("GCP_PROJECT_ID is not set")
    return f"gs://{project}-datasets/{name}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
