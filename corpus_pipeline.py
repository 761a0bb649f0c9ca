"""The corpus pipeline: language, near copies, repeated passages, mixture, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orrery.llm import stages
from orrery.runtime import scratch_path
from orrery.sources.paths import table

#: Name and function of each stage; each takes (spark, docs, sf_dir).
STAGES = [
    ("language_id", stages.language_stage),
    ("simhash_dedup", stages.simhash_stage),
    ("substring_dedup", stages.substring_stage),
    ("mix_sources", stages.mixing_stage),
    ("pack", stages.packing_stage),
]

#: A trained network, XXH64 and a tokenizer lie outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
