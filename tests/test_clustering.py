from dataclasses import replace

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orrery.operators import clustering, metrics
from orrery.operators.clustering import KMeansConfig
from orrery.plans import health_clustering
from orrery.plans.health_view import HEALTH_VIEW_SQL, health_view


@pytest.fixture(scope="module")
def health(spark, data):
    return health_view(spark, data).cache()


@pytest.fixture(scope="module")
def fitted(health):
    return clustering.fit_kmeans(health, KMeansConfig())


def test_health_view_is_its_sql(spark, data, health):
    for name in ("events", "customer", "nation"):
        spark.read.parquet(f"{data}/{name}.parquet").createOrReplaceTempView(name)
    other = spark.sql(HEALTH_VIEW_SQL)
    assert other.count() == health.count()
    assert other.exceptAll(health.select(*other.columns)).count() == 0


@pytest.mark.parametrize("given,want", [
    (None, 5), ("3", 3), ("x", 5), ("0", 1), ("-4", 1), ("2.5", 5), (" 7 ", 7), ("", 5),
])
def test_category_weight(given, want, monkeypatch):
    assert clustering.category_weight(given) == want
    if given is None:
        monkeypatch.delenv("MEASURE_NAME_WEIGHT", raising=False)
    else:
        monkeypatch.setenv("MEASURE_NAME_WEIGHT", given)
    assert KMeansConfig.from_env().weight == want


def test_profile_is_the_separate_counts(health):
    seen = clustering.profile(health)
    present = health.filter("measure_name is not null")
    assert seen.rows == health.count() and seen.missing_category == health.filter("measure_name is null").count()
    for c, mean in seen.means.items():
        want = present.filter(~F.isnan(c) & F.col(c).isNotNull()).agg(F.avg(c)).first()[0]
        assert mean == pytest.approx(want, rel=1e-12)
    counts = present.groupBy("measure_name").count().collect()
    assert seen.categories == [r[0] for r in sorted(counts, key=lambda r: (-r[1], r[0]))]


def test_scaled_weight_equals_repeated_blocks(health):
    cfg = KMeansConfig.unweighted(weight=5)
    scaled, repeated = clustering.fit_kmeans(health, cfg), clustering.fit_kmeans(health, replace(cfg, weighting="repeated"))
    assert scaled.model.summary.trainingCost == pytest.approx(repeated.model.summary.trainingCost, rel=1e-9)
    rows = clustering.prepare(health, scaled, cfg)
    a = {r["id"]: r["prediction"] for r in clustering.infer(rows, scaled).collect()}
    b = {r["id"]: r["prediction"] for r in clustering.infer(rows, repeated).collect()}
    assert a == b
    narrow, wide = len(scaled.model.clusterCenters()[0]), len(repeated.model.clusterCenters()[0])
    assert wide - 3 == 5 * (narrow - 3)


def test_same_seed_same_centers(health, fitted):
    again = clustering.fit_kmeans(health, KMeansConfig())
    assert np.allclose(np.array(again.model.clusterCenters()), np.array(fitted.model.clusterCenters()))


def test_every_row_is_at_its_nearest_center(health, fitted):
    predictions = clustering.infer(clustering.prepare(health, fitted), fitted)
    centers = np.array(fitted.model.clusterCenters())
    got = predictions.select("prediction", vector_to_array("features").alias("v")).collect()
    points = np.array([r["v"] for r in got])
    distances = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2)
    chosen = distances[np.arange(len(got)), [r["prediction"] for r in got]]
    assert np.allclose(chosen, distances.min(axis=1))
    assert sum(fitted.model.summary.clusterSizes) == len(got)


def test_unseen_and_probe_rows(spark, fitted):
    rows = clustering.infer(clustering.probe_rows(spark), fitted)
    assert rows.count() == 7
    block = rows.select(vector_to_array("features").alias("v")).first()["v"]
    assert set(block[:-3]) == {0.0} and block[-3:] == [0.0, 7.0, 5.0]
    prediction, single = clustering.infer_row(spark, fitted, "Asthma", 10)
    assert single.count() == 1
    assert prediction == rows.filter("measure_name = 'Asthma'").first()["prediction"]


def test_inference_needs_a_model(spark):
    with pytest.raises(RuntimeError):
        clustering.infer(clustering.probe_rows(spark), None)


def test_fewer_distinct_rows_than_clusters(spark):
    rows = spark.createDataFrame([(c, 1.0, 1.0, 1.0) for c in "abcde"] * 20,
                                 "measure_name string, value double, lower_ci double, upper_ci double")
    few = clustering.fit_kmeans(rows, KMeansConfig())
    assert 1 <= len(few.model.clusterCenters()) <= 25


def test_save_replaces_and_load_scores(spark, health, fitted, tmp_path, monkeypatch):
    base = str(tmp_path / "models")
    clustering.save_fitted(fitted, base)
    clustering.save_fitted(fitted, base)
    monkeypatch.setenv("MODEL_OUTPUT_DIR", base)
    loaded = clustering.load_fitted()
    assert not loaded.model.hasSummary
    a = clustering.infer(clustering.probe_rows(spark), fitted).select("measure_name", "prediction").collect()
    b = clustering.infer(clustering.probe_rows(spark), loaded).select("measure_name", "prediction").collect()
    assert sorted(a) == sorted(b)


def test_scored_job(health, tmp_path):
    result = health_clustering.cluster(health, KMeansConfig.unweighted(), score=True, save_to=str(tmp_path / "m"))
    assert -1 <= result.silhouette <= 1
    assert len(clustering.load_fitted(str(tmp_path / "m")).model.clusterCenters()) == 5


def brute_silhouette(points, clusters):
    points, clusters = np.array(points, float), np.array(clusters)
    d = ((points[:, None, :] - points[None]) ** 2).sum(axis=2)
    scores = []
    for i, c in enumerate(clusters):
        own = clusters == c
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][clusters == o].mean() for o in set(clusters) if o != c)
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_silhouette_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(200, 3)).round(3).tolist()
    clusters = [0] * 70 + [1] * 129 + [2]
    df = spark.createDataFrame([(c, *p) for c, p in zip(clusters, points)], "cluster int, a double, b double, c double")
    got = metrics.silhouette(df, ["a", "b", "c"]).first()[0]
    assert got == pytest.approx(brute_silhouette(points, clusters), abs=1e-9)
    plan = metrics.silhouette_rows(df, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_weighted_distance_and_nearest_center(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 3.0)], "c string, v double")
    distance = clustering.weighted_distance(F.col("c"), F.lit("x"), 5, [(F.col("v"), F.lit(0.0))])
    assert [r[0] for r in df.select(distance).collect()] == [1.0, 19.0]
    tie = clustering.nearest_center(df, ["v"], [[0.0], [2.0], [4.0]]).collect()
    assert [(r["cluster"], r["distance"]) for r in tie] == [(0, 1.0), (1, 1.0)]


def test_metrics_against_numpy(spark):
    probabilities = [[0.7, 0.2, 0.1], [0.0, 1.0, 0.0], [0.3, 0.3, 0.4]]
    labels = [0, 0, 2]
    df = spark.createDataFrame(list(zip(probabilities, labels)), "p array<double>, label int")
    row = metrics.classification_metrics(df, "p", "label").first()
    losses = [-math.log(min(max(p[y], 1e-7), 1 - 1e-7)) for p, y in zip(probabilities, labels)]
    assert row["accuracy"] == pytest.approx(2 / 3) and row["log_loss"] == pytest.approx(np.mean(losses))
    points = spark.createDataFrame([(1.0, 2.0, 0.0, 0.0), (3.0, 3.0, 5.0, 1.0)], "x double, xh double, y double, yh double")
    pairs = [("xh", "x"), ("yh", "y")]
    row = metrics.regression_metrics(points, pairs).first()
    assert row["mae"] == metrics.mean_absolute_error(points, pairs).first()[0] == pytest.approx(5 / 4)
    assert row["mse"] == metrics.mean_squared_error(points, pairs).first()[0] == pytest.approx(17 / 4)


def test_history_summary(spark):
    history = spark.createDataFrame([(1, "mae", 5.0), (2, "mae", 2.0), (3, "mae", 2.0), (4, "mae", 9.0)],
                                    "epoch int, metric string, value double")
    row = metrics.history_summary(history).first()
    assert (row["last_value"], row["best_value"], row["best_epoch"]) == (9.0, 2.0, 2)
