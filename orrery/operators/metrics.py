"""Cluster scores, regression and classification metrics, training history."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orrery.functions.nested import argmax
from orrery.functions.numbers import floor_div

# Fixed value: probabilities are kept this far from 0 and 1 before the logarithm.
PROBABILITY_EDGE = 1e-7


def silhouette_rows(df: DataFrame, columns: list[str] | str, cluster: str = "cluster") -> DataFrame:
    """Silhouette of every row with squared Euclidean distance, in linear time.

    ``columns`` are numeric columns, or one array column of equally long rows. The mean
    distance from x to a cluster with n rows, mean m and mean squared norm p is
    |x|^2 + p - 2 x.m, so sums per cluster are enough: each Arrow batch adds up its rows,
    and one row per cluster, as many as the cluster centres, goes to the executors with the
    second pass, where one matrix product per batch gives all distances. Rows are neither
    shuffled nor joined, however uneven the clusters are.
    """
    features = F.col(columns) if isinstance(columns, str) else F.array(*[F.col(c).cast("double") for c in columns])
    rows = df.select(F.col(cluster).cast("long").alias("c"), features.cast("array<double>").alias("x"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            own, x = batch.column("c").to_numpy(), np.stack(batch.column("x").to_numpy(zero_copy_only=False))
            for c in np.unique(own):
                mine = x[own == c]
                sums = np.concatenate([[len(mine), (mine * mine).sum()], mine.sum(axis=0)])
                totals[int(c)] = totals.get(int(c), 0) + sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int64()), pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64()))], names=["c", "sums"]
        )

    parts = rows.mapInArrow(add_up, "c long, sums array<double>").select("c", F.posexplode("sums").alias("slot", "v"))
    found = parts.groupBy("c", "slot").agg(F.sum("v").alias("v")).groupBy("c").agg(
        F.array_sort(F.collect_list(F.struct("slot", "v"))).alias("sums")
    ).orderBy("c").collect()
    if len(found) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    names = np.array([row["c"] for row in found])
    table = np.array([[cell["v"] for cell in row["sums"]] for row in found])
    sizes, norms, means = table[:, 0], table[:, 1] / table[:, 0], table[:, 2:] / table[:, :1]

    @F.pandas_udf("double")
    def score(own: pd.Series, features: pd.Series) -> pd.Series:
        x = np.stack(features.to_numpy()) if len(features) else np.zeros((0, means.shape[1]))
        mine = np.searchsorted(names, own.to_numpy())
        at = np.arange(len(x))
        distance = (x * x).sum(axis=1)[:, None] + norms - 2.0 * (x @ means.T)
        size = sizes[mine]
        inside = distance[at, mine] * size / np.maximum(size - 1, 1)
        distance[at, mine] = np.inf
        outside = distance.min(axis=1)
        longest = np.maximum(inside, outside)
        spread = np.divide(outside - inside, longest, out=np.zeros_like(longest), where=longest > 0)
        return pd.Series(np.where(size == 1, 0.0, spread))

    return df.withColumn("silhouette", score(F.col(cluster), features.cast("array<double>")))


def silhouette(df: DataFrame, columns: list[str] | str, cluster: str = "cluster") -> DataFrame:
    return silhouette_rows(df, columns, cluster).agg(F.avg("silhouette").alias("silhouette"))


def cluster_centers(df: DataFrame, columns: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean of every column per cluster in long form: cluster, slot, value."""
    means = df.groupBy(cluster).agg(F.array(*[F.avg(c) for c in columns]).alias("center"))
    return means.select(cluster, F.posexplode("center").alias("slot", "value"))


def mean_absolute_error(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Mean over rows and over all (prediction, target) pairs."""
    total = sum((F.abs(F.col(p) - F.col(t)) for p, t in pairs), F.lit(0.0))
    return df.agg(F.avg(total / len(pairs)).alias("mae"))


def mean_squared_error(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    total = sum(((F.col(p) - F.col(t)) * (F.col(p) - F.col(t)) for p, t in pairs), F.lit(0.0))
    return df.agg(F.avg(total / len(pairs)).alias("mse"))


def regression_metrics(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """MAE, MSE and row count in one pass."""
    diff = [F.col(p) - F.col(t) for p, t in pairs]
    absolute = sum((F.abs(d) for d in diff), F.lit(0.0)) / len(pairs)
    squared = sum((d * d for d in diff), F.lit(0.0)) / len(pairs)
    return df.agg(F.avg(absolute).alias("mae"), F.avg(squared).alias("mse"), F.count(F.lit(1)).alias("n"))


def log_loss(probabilities: Column, label: Column) -> Column:
    """Cross-entropy of one row: minus the log of the label's clipped probability."""
    p = F.element_at(probabilities, label.cast("int") + 1)
    return -F.log(F.least(F.greatest(p, F.lit(PROBABILITY_EDGE)), F.lit(1 - PROBABILITY_EDGE)))


def classification_metrics(df: DataFrame, probabilities: str, label: str) -> DataFrame:
    """Accuracy, cross-entropy and row count in one pass."""
    hit = (argmax(F.col(probabilities)) == F.col(label).cast("int")).cast("double")
    return df.agg(
        F.avg(hit).alias("accuracy"),
        F.avg(log_loss(F.col(probabilities), F.col(label))).alias("log_loss"),
        F.count(F.lit(1)).alias("n"),
    )


def epoch_means(df: DataFrame, epoch: str, columns: list[str]) -> DataFrame:
    """Running means of an epoch, restarted at each epoch."""
    return df.groupBy(epoch).agg(*[F.avg(c).alias(c) for c in columns])


def history_long(df: DataFrame, epoch: str, metrics: list[str]) -> DataFrame:
    """Wide per-epoch metrics to (epoch, metric, value)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return df.select(F.col(epoch).alias("epoch"), F.explode(pairs).alias("p")).select(
        "epoch", "p.metric", "p.value"
    )


def history_summary(history: DataFrame) -> DataFrame:
    """Last value and best (smallest, first reached) value of each metric."""
    return history.groupBy("metric").agg(
        F.max_by("value", "epoch").alias("last_value"),
        F.min("value").alias("best_value"),
        F.min_by("epoch", F.struct("value", "epoch")).alias("best_epoch"),
    )


def steps_per_epoch(df: DataFrame, batch_size: int) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n"), F.greatest(F.lit(1).cast("bigint"), floor_div(n, batch_size)).alias("steps_per_epoch")
    )
