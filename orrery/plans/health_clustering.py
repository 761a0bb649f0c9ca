"""Clustering jobs: from a table, a JDBC source or a CSV to fitted, scored and saved clusters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.operators import clustering
from orrery.operators.clean import numbers_from_text, present
from orrery.operators.clustering import Fitted, KMeansConfig
from orrery.plans.health_view import health_view
from orrery.runtime import freeze
from orrery.sources.delimited import read_csv_inferred, read_csv_missing
from orrery.sources.jdbc import JdbcConfig, KeyRange, read_jdbc


@dataclass(frozen=True)
class ClusteringResult:
    fitted: Fitted
    predictions: DataFrame
    silhouette: float | None = None


def cluster(source: DataFrame, cfg: KMeansConfig, score: bool = False, save_to: str | None = None) -> ClusteringResult:
    """Fit, assign, and on request score and save."""
    fitted = clustering.fit_kmeans(source, cfg)
    predictions = clustering.infer(clustering.prepare(source, fitted, cfg), fitted)
    silhouette = clustering.silhouette_of(predictions) if score else None
    if save_to:
        clustering.save_fitted(fitted, save_to)
    return ClusteringResult(fitted, predictions, silhouette)


def cluster_jdbc(spark: SparkSession, db: JdbcConfig | None = None, cfg: KMeansConfig | None = None,
                 split: KeyRange | str | None = "derived", save_to: str | None = None) -> ClusteringResult:
    """Database table to weighted clusters.

    Training needs two passes, so the table is copied once to scratch (the
    columns in use only) instead of being read from the database twice.
    """
    cfg = cfg or KMeansConfig.from_env()
    source = read_jdbc(spark, db or JdbcConfig.from_env(), split)
    needed = [cfg.category, *present(source, cfg.numeric)]
    return cluster(freeze(source.select(*needed), "table"), cfg, save_to=save_to)


def cluster_csv(spark: SparkSession, path: str, cfg: KMeansConfig | None = None, infer_types: bool = False,
                save_to: str | None = None, multiline: bool = True) -> ClusteringResult:
    """CSV to five scored clusters. A declared schema saves the pass that inference needs."""
    cfg = cfg or KMeansConfig.unweighted()
    source = read_csv_inferred(spark, path, multiline) if infer_types else read_csv_missing(spark, path, multiline=multiline)
    return cluster(numbers_from_text(source, cfg.numeric), cfg, score=True, save_to=save_to)


def summarize(predictions: DataFrame) -> DataFrame:
    """(cluster, n, avg_value, avg_lower_ci, avg_upper_ci) of assigned rows."""
    return predictions.groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in ("value", "lower_ci", "upper_ci")],
    )


def cluster_summary(spark: SparkSession, folder: str, cfg: KMeansConfig | None = None) -> DataFrame:
    """Size and means of the clusters of the health rows."""
    return summarize(cluster(health_view(spark, folder), cfg or KMeansConfig()).predictions)
