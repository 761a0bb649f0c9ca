import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators import clustering
from orrery.operators.clustering import KMeansConfig
from orrery.operators.wide_clustering import fit_wide, infer_wide, load_wide, save_wide, wide_center_rows
from orrery.plans.health_view import health_view

SCHEMA = "c string, x double, y double"


def config(**changes):
    return KMeansConfig(**{"category": "c", "numeric": ["x", "y"], "k": 3, "weight": 4, **changes})


def lloyd(rows, start, weight, turns):
    """Plain turns over laid-out rows; the categories are numbered by frequency, then name."""
    names = [r[0] for r in rows]
    order = sorted(set(names), key=lambda n: (-names.count(n), n))

    def lay(c, numbers):
        return np.array([math.sqrt(weight) * (c == n) for n in order] + list(numbers))

    points = np.array([lay(c, v) for c, *v in rows])
    centers = np.array([lay(c, v) for c, v in start])
    for _ in range(turns):
        distances = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
        near = distances.argmin(axis=1)
        for i in set(near.tolist()):
            centers[i] = points[near == i].mean(axis=0)
    return centers, distances.min(axis=1).sum(), len(order)


def laid_out(fitted, width):
    centers = np.zeros((len(fitted.centers), width))
    for r in wide_center_rows(fitted).collect():
        centers[r["cluster"], r["slot"]] = r["value"]
    return centers


@pytest.fixture(scope="module")
def sample(spark):
    random = np.random.default_rng(3)
    rows = [(f"c{random.integers(40) if random.random() > 0.3 else 0}", float(random.normal()), float(random.normal() * 3))
            for _ in range(400)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("turns", [1, 2, 6])
def test_turns_equal_those_over_laid_out_rows(sample, turns):
    rows, df = sample
    # The last centre is far from every row: it keeps its place and its share.
    start = [("c0", [0.0, 1.0]), ("c3", [1.0, -2.0]), ("unseen", [0.5, 0.5]), ("c5", [500.0, 0.0])]
    want, cost, categories = lloyd(rows, start, 4, turns)
    fitted = fit_wide(df, config(k=4, max_iter=turns), start, tol=0.0)
    assert np.allclose(laid_out(fitted, categories + 2), want, atol=1e-9)
    assert fitted.cost == pytest.approx(cost, rel=1e-9)
    assert fitted.sizes[3] == 0 and sum(fitted.sizes) == len(rows)


def test_a_shuffled_join_gives_the_same_centres(spark, sample, monkeypatch):
    _, df = sample
    start = [("c0", [0.0, 1.0]), ("c3", [1.0, -2.0])]
    a = fit_wide(df, config(k=2, max_iter=3), start)
    monkeypatch.setattr("orrery.operators.joins.fits_broadcast", lambda right: False)
    b = fit_wide(df, config(k=2, max_iter=3), start)
    assert np.allclose(a.centers, b.centers) and np.allclose(a.norms, b.norms) and a.sizes == b.sizes
    near = infer_wide(df.unionByName(spark.createDataFrame([(None, 0.0, 0.0), ("new", 1.0, 1.0)], SCHEMA)), b)
    assert near.count() == 402 and near.filter(F.col("prediction").isNull()).count() == 0


def test_cost_is_near_that_of_the_built_in_trainer(spark, data):
    health = health_view(spark, data).cache()
    cfg = KMeansConfig.unweighted(weight=5, max_iter=12)
    built_in = clustering.fit_kmeans(health, cfg)
    ours = fit_wide(health, cfg)
    assert ours.cost <= 1.15 * built_in.model.summary.trainingCost
    assert sum(ours.sizes) == health.filter("measure_name is not null").count()


def test_predictions_are_the_nearest_centres(spark, sample):
    rows, df = sample
    fitted = fit_wide(df, config(max_iter=5))
    order = {r["c"]: r["idx"] for r in fitted.dictionary.collect()}
    centers = laid_out(fitted, len(order) + 2)
    asked = rows[:50] + [("new", 0.0, 0.0), (None, 1.0, 1.0), ("c1", None, 2.0), ("c1", float("nan"), 2.0)]
    got = infer_wide(spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "id int, " + SCHEMA), fitted).collect()
    assert len(got) == len(asked)
    for r in got:
        v = np.zeros(len(order) + 2)
        if r["c"] in order:
            v[order[r["c"]]] = 2.0
        x = fitted.means["x"] if r["x"] is None or math.isnan(r["x"]) else r["x"]
        v[-2:] = x, r["y"]
        distances = ((centers - v) ** 2).sum(axis=1)
        assert distances[r["prediction"]] == pytest.approx(distances.min(), abs=1e-9)


def test_saved_model_predicts_the_same(spark, sample, tmp_path):
    _, df = sample
    fitted = fit_wide(df, config(max_iter=3))
    save_wide(fitted, str(tmp_path / "m"))
    again = load_wide(spark, str(tmp_path / "m"))
    assert again.centers == fitted.centers and again.sizes == fitted.sizes
    assert infer_wide(df, again).exceptAll(infer_wide(df, fitted)).count() == 0


def test_odd_tables(spark):
    with pytest.raises(ValueError, match="no rows"):
        fit_wide(spark.createDataFrame([], SCHEMA), config())
    with pytest.raises(ValueError, match="no rows"):
        fit_wide(spark.createDataFrame([(None, 1.0, 1.0)], SCHEMA), config())
    equal = fit_wide(spark.createDataFrame([("a", 1.0, None)] * 20, SCHEMA), config())
    assert equal.centers == [[1.0]] and equal.sizes == [20] and equal.cost == 0
    only = fit_wide(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string"), config(k=2))
    assert sorted(only.sizes) == [1, 2] and only.centers == [[], []]
    extra = spark.createDataFrame([("a", 1.0, 1.0, 7, 8), ("b", 9.0, 9.0, 7, 8)], SCHEMA + ", cluster int, prediction int")
    near = infer_wide(extra, fit_wide(extra, config(k=2)))
    assert near.columns == ["c", "x", "y", "cluster", "prediction"]
    assert len({r["prediction"] for r in near.collect()}) == 2
    with pytest.raises(ValueError, match="reserved"):
        infer_wide(extra.withColumn("_near", F.lit(1)), equal)


def test_a_million_categories(spark):
    """Three groups by a number; every category belongs to one, one of them to a third of all rows."""
    rows = spark.range(1_500_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-3)).otherwise(F.col("id")).cast("string").alias("c"),
        (F.col("id") % 3 * 100 + F.col("id") % 7).cast("double").alias("x"),
    )
    fitted = fit_wide(rows, KMeansConfig(category="c", numeric=["x"], k=3, max_iter=4))
    assert sorted(fitted.sizes) == [500_000] * 3
    assert fitted.dictionary.count() == 1_000_001 == fitted.shares.count()
    assert sorted(round(p * 500_000, 3) for p in fitted.norms) == [1.0, 1.0, 500_000.0]


def test_too_many_categories_for_the_driver_are_an_error(spark, sample, monkeypatch):
    monkeypatch.setattr(clustering, "MOST_CATEGORIES", 10)
    with pytest.raises(ValueError, match="categories; wide_clustering"):
        clustering.fit_kmeans(sample[1], config())
    nine = sample[1].filter(F.col("c").isin([f"c{i}" for i in range(9)]))
    assert len(clustering.profile(nine, "c", ["x"]).categories) == 9
