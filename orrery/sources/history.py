"""Training history files: one JSON object of equally long arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

METRICS = ["loss", "mae", "mse"]


def read_history(spark: SparkSession, path: str, metrics: list[str] = METRICS) -> DataFrame:
    """(epoch, metric, value), epochs counted from 1."""
    schema = ", ".join(f"{m} array<double>" for m in metrics)
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    wide = document.select(F.posexplode(F.arrays_zip(*metrics)).alias("at", "row"))
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col("row")[m].alias("value")) for m in metrics])
    return wide.select((F.col("at") + 1).alias("epoch"), F.explode(pairs).alias("p")).select(
        "epoch", "p.metric", "p.value"
    )
