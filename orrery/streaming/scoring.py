"""Cluster assignment of a stream of new rows with an already fitted model.

Stateless: each micro-batch goes through the same plan as a batch of rows, so no
watermark or state store is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from orrery.operators.clustering import Fitted, infer
from orrery.runtime import scratch_path

ROW_SCHEMA = "measure_name string, value double, lower_ci double, upper_ci double"


def read_row_stream(spark: SparkSession, path: str, schema: str = ROW_SCHEMA, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def score_stream(rows: DataFrame, fitted: Fitted, output: str, checkpoint: str | None = None) -> StreamingQuery:
    """Write (input columns, prediction) as parquet with exactly-once file commits.

    Pass a lasting ``checkpoint`` folder if the query is to go on after a restart.
    """
    scored = infer(rows, fitted).select(*rows.columns, "prediction")
    checkpoint = checkpoint or scratch_path(rows.sparkSession, "scoring")
    return (
        scored.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
