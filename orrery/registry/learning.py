"""Encoders, features, clustering, supervised training and their metrics."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.operators import clean, clustering, encode, images, metrics, networks, rows, supervised, wide_clustering
from orrery.operators.clustering import KMeansConfig
from orrery.plans import derived_inputs, health_clustering, supervised_training
from orrery.plans.health_view import health_view
from orrery.registry.base import IMPUTED_SQL, over_health, query
from orrery.runtime import freeze, scratch_path
from orrery.sinks.files import write_image_predictions
from orrery.sources.paths import table

_NUMBERS = clean.NUMERIC_COLUMNS
#: Pictures of full size that one task resizes.
PICTURES_PER_TASK = 2000


# --- encoders -------------------------------------------------------------------------

@query("category_frequency", over_health("""
SELECT measure_name, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, measure_name) - 1 AS idx
FROM hv WHERE measure_name IS NOT NULL GROUP BY measure_name"""))
def category_frequency(spark: SparkSession, folder: str) -> DataFrame:
    ranked = encode.category_frequency(health_view(spark, folder), "measure_name")
    return ranked.withColumn("idx", F.col("idx").cast("bigint"))


_RANKS = """
, ranks AS (
  SELECT measure_name, row_number() OVER (ORDER BY count(*) DESC, measure_name) - 1 AS idx
  FROM hv WHERE measure_name IS NOT NULL GROUP BY measure_name)
"""


@query("string_index", over_health(f"""{_RANKS}
SELECT id, hv.measure_name, CAST(coalesce(r.idx, (SELECT count(*) FROM ranks)) AS DOUBLE) AS measure_name_index
FROM hv LEFT JOIN ranks r ON r.measure_name = hv.measure_name"""))
def string_index(spark: SparkSession, folder: str) -> DataFrame:
    rows_ = health_view(spark, folder).select("id", "measure_name")
    return encode.string_index(rows_, "measure_name", "measure_name_index").select(
        "id", "measure_name", "measure_name_index"
    )


@query("one_hot", over_health(f"""{_RANKS}
SELECT id, CAST(r.idx AS INTEGER) AS slot, CAST(1 AS DOUBLE) AS value
FROM hv JOIN ranks r ON r.measure_name = hv.measure_name"""))
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows_ = health_view(spark, folder).select("id", "measure_name")
    categories = encode.category_frequency(rows_, "measure_name")
    indexed = encode.string_index(rows_, "measure_name", "i", categories)
    return encode.one_hot_rows(indexed, "i", categories.count(), ["id"])


@query("label_encode", over_health("""
, l AS (SELECT id, trim(subpopulation) AS subpopulation FROM hv WHERE trim(subpopulation) <> '')
SELECT id, subpopulation, CAST(dense_rank() OVER (ORDER BY subpopulation) - 1 AS INTEGER) AS label_idx FROM l"""))
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    labelled = clean.rows_labelled(health_view(spark, folder), "subpopulation").select("id", "subpopulation")
    return encode.label_encode(labelled, "subpopulation").select("id", "subpopulation", "label_idx")


@query("label_map_json", over_health("""
SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx, label
FROM (SELECT DISTINCT trim(subpopulation) AS label FROM hv WHERE trim(subpopulation) <> '')"""))
def label_map_json(spark: SparkSession, folder: str) -> DataFrame:
    """The label map written as one JSON object, read back as rows."""
    from orrery.sinks.files import write_label_map

    labelled = clean.rows_labelled(health_view(spark, folder), "subpopulation")
    path = scratch_path(spark, "label-map")
    write_label_map(encode.vocabulary(labelled, "subpopulation", "idx"), "subpopulation", "idx", path)
    entries = F.explode(F.from_json("value", "map<string,string>")).alias("idx", "label")
    return spark.read.text(path).select(entries).select(F.col("idx").cast("int").alias("idx"), "label")


@query("feature_array", over_health("""
SELECT id, x.slot - 1 AS slot, round(CAST(CAST(x.value AS FLOAT) AS DOUBLE), 4) AS value FROM (
  SELECT id, unnest([1, 2, 3]) AS slot, unnest([value, lower_ci, upper_ci]) AS value FROM hv
  WHERE trim(subpopulation) <> '' AND value IS NOT NULL AND NOT isnan(value)
    AND lower_ci IS NOT NULL AND upper_ci IS NOT NULL) x"""))
def feature_array(spark: SparkSession, folder: str) -> DataFrame:
    arrays = encode.feature_array(clean.complete_cases(health_view(spark, folder)))
    slots = arrays.select("id", F.posexplode("x").alias("slot", "v"))
    return slots.select("id", "slot", F.round(F.col("v").cast("double"), 4).alias("value"))


def _feature_slots(spark: SparkSession, folder: str, cfg: KMeansConfig) -> DataFrame:
    stages, cleaned, _ = clustering.fit_features(health_view(spark, folder), cfg)
    vectors = stages.transform(cleaned).select("id", vector_to_array("features").alias("v"))
    slots = vectors.select("id", F.posexplode("v").alias("slot", "x"))
    return slots.select("id", "slot", F.round("x", 6).alias("value"))


def _slots_sql(scale: float) -> str:
    return over_health(f""", {IMPUTED_SQL.strip()}
SELECT c.id, CAST(r.idx AS INTEGER) AS slot,
  round(CASE WHEN r.measure_name = c.measure_name THEN {scale!r} ELSE 0.0 END, 6) AS value
FROM clean c CROSS JOIN ranks r
UNION ALL
SELECT id, CAST((SELECT count(*) FROM ranks) + unnest([0, 1, 2]) AS INTEGER) AS slot,
  round(unnest([value, lower_ci, upper_ci]), 6) AS value FROM clean""")


@query("assemble_features", _slots_sql(1.0))
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    return _feature_slots(spark, folder, KMeansConfig.unweighted())


@query("staged_transform", _slots_sql(math.sqrt(5)))
def staged_transform(spark: SparkSession, folder: str) -> DataFrame:
    return _feature_slots(spark, folder, KMeansConfig())


@query("weighted_category_distance", over_health(f""", {IMPUTED_SQL.strip()}
SELECT id, round((CASE WHEN measure_name = 'click' THEN 0 ELSE 10 END)
  + (value - 50) * (value - 50) + (lower_ci - 25) * (lower_ci - 25) + (upper_ci - 75) * (upper_ci - 75), 8) AS distance
FROM clean"""))
def weighted_category_distance(spark: SparkSession, folder: str) -> DataFrame:
    """Distance of each row's weighted feature vector from that of one fixed row."""
    cfg = KMeansConfig()
    stages, cleaned, _ = clustering.fit_features(health_view(spark, folder), cfg)
    fixed = spark.createDataFrame([("click", 50.0, 25.0, 75.0)], "measure_name string, value double, lower_ci double, upper_ci double")
    point = [float(v) for v in stages.transform(fixed).first()["features"].toArray()]
    vectors = stages.transform(cleaned).select("id", vector_to_array("features").alias("v"))
    squares = F.zip_with("v", F.array(*[F.lit(p) for p in point]), lambda a, b: (a - b) * (a - b))
    total = F.aggregate(squares, F.lit(0.0), lambda acc, d: acc + d)
    return vectors.select("id", F.round(total, 8).alias("distance"))


# --- clustering -----------------------------------------------------------------------

_PARTS = """
, p AS (SELECT p_partkey AS id, CASE WHEN p_partkey = 0 THEN 9 ELSE p_partkey % 5 END AS cluster,
  CAST(p_size AS DOUBLE) AS a, p_retailprice / 100 AS b FROM part)
"""


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    cluster = F.when(F.col("p_partkey") == 0, F.lit(9)).otherwise(F.col("p_partkey") % 5).cast("bigint")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), cluster.alias("cluster"), F.col("p_size").cast("double").alias("a"),
        (F.col("p_retailprice") / 100).alias("b"),
    )


# The oracle compares every pair of rows; the operator does not.
@query("silhouette_fixed_assign", "WITH " + _PARTS.strip().removeprefix(", ") + """
, d AS (SELECT x.id, x.cluster, y.cluster AS other, count(*) AS n,
    sum((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) AS total
  FROM p x CROSS JOIN p y GROUP BY 1, 2, 3),
s AS (SELECT id, max(CASE WHEN cluster = other THEN n END) AS own_n,
    max(CASE WHEN cluster = other AND n > 1 THEN total / (n - 1) END) AS a,
    min(CASE WHEN cluster <> other THEN total / n END) AS b FROM d GROUP BY id)
SELECT round(avg(CASE WHEN own_n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""")
def silhouette_fixed_assign(spark: SparkSession, folder: str) -> DataFrame:
    score = metrics.silhouette(_parts(spark, folder), ["a", "b"])
    return score.select(F.round("silhouette", 6).alias("silhouette"))


@query("cluster_centers_fixed", "WITH " + _PARTS.strip().removeprefix(", ") + """
SELECT cluster, 0 AS slot, round(avg(a), 6) AS value FROM p GROUP BY cluster
UNION ALL SELECT cluster, 1, round(avg(b), 6) FROM p GROUP BY cluster""")
def cluster_centers_fixed(spark: SparkSession, folder: str) -> DataFrame:
    centers = metrics.cluster_centers(_parts(spark, folder), ["a", "b"])
    return centers.select("cluster", "slot", F.round("value", 6).alias("value"))


@query("nearest_center_fixed", "WITH " + _PARTS.strip().removeprefix(", ") + """
, c(cluster, ca, cb) AS (VALUES (0, 10.0, 9.5), (1, 25.0, 12.0), (2, 40.0, 18.0)),
d AS (SELECT p.id, c.cluster, (a - ca) * (a - ca) + (b - cb) * (b - cb) AS distance,
  row_number() OVER (PARTITION BY p.id ORDER BY (a - ca) * (a - ca) + (b - cb) * (b - cb), c.cluster) AS r
  FROM p CROSS JOIN c)
SELECT id, CAST(cluster AS INTEGER) AS cluster, round(distance, 6) AS distance FROM d WHERE r = 1""")
def nearest_center_fixed(spark: SparkSession, folder: str) -> DataFrame:
    centers = [[10.0, 9.5], [25.0, 12.0], [40.0, 18.0]]
    nearest = clustering.nearest_center(_parts(spark, folder).drop("cluster"), ["a", "b"], centers)
    return nearest.select("id", "cluster", F.round("distance", 6).alias("distance"))


def _health(spark: SparkSession, folder: str) -> DataFrame:
    """The columns that clustering needs, written once for profile, training and prediction."""
    return freeze(health_view(spark, folder).select("id", "measure_name", *_NUMBERS), "health")


def _fit_small(spark: SparkSession, folder: str, **changes) -> tuple[clustering.Fitted, DataFrame]:
    """Five clusters without category weight, and the predictions for the training rows."""
    cfg = KMeansConfig.unweighted(**changes)
    source = _health(spark, folder)
    fitted = clustering.fit_kmeans(source, cfg)
    return fitted, clustering.infer(clustering.prepare(source, fitted, cfg), fitted)


def _nearest(predictions: DataFrame, model) -> DataFrame:
    """Columns ``own`` (squared distance to the assigned centre) and ``is_nearest``."""
    distances = predictions.withColumn("v", vector_to_array("features")).withColumn("d", F.array(*_distance_to(model)))
    own = F.element_at("d", F.col("prediction") + 1)
    return distances.withColumn("own", own).withColumn("is_nearest", F.col("own") <= F.array_min("d") + F.lit(1e-6))


def _distance_to(model, vector: str = "v") -> list:
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    return [
        F.aggregate(F.zip_with(vector, F.array(*[F.lit(x) for x in c]), lambda a, b: (a - b) * (a - b)),
                    F.lit(0.0), lambda acc, d: acc + d)
        for c in centers
    ]


@query("kmeans_train_cost", over_health("""
SELECT count(*) AS n_rows, true AS cost_matches, true AS all_centers_used FROM hv WHERE measure_name IS NOT NULL"""))
def kmeans_train_cost(spark: SparkSession, folder: str) -> DataFrame:
    """25 clusters, weight 5, up to 1000 iterations: the recomputed distances add up to the training cost."""
    cfg = KMeansConfig()
    source = _health(spark, folder)
    fitted = clustering.fit_kmeans(source, cfg)
    scored = _nearest(clustering.infer(clustering.prepare(source, fitted, cfg), fitted), fitted.model)
    cost = float(fitted.model.summary.trainingCost)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("own").between(0.999 * cost, cost * (1 + 1e-9)).alias("cost_matches"),
        (F.countDistinct("prediction") == len(fitted.model.clusterCenters())).alias("all_centers_used"),
    )


@query("kmeans_predict", over_health("SELECT id, measure_name, true AS is_nearest FROM hv WHERE measure_name IS NOT NULL"))
def kmeans_predict(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with whether the centre it is assigned to is its nearest."""
    fitted, predictions = _fit_small(spark, folder)
    return _nearest(predictions, fitted.model).select("id", "measure_name", "is_nearest")


@query("kmeans_assignment_check", over_health("""
SELECT count(*) AS n_rows, count(*) AS n_nearest, true AS cost_matches FROM hv WHERE measure_name IS NOT NULL"""))
def kmeans_assignment_check(spark: SparkSession, folder: str) -> DataFrame:
    """Every row sits at its nearest centre and the distances add up to the training cost.

    The trainer reports the cost seen in its last pass, before the centres moved
    once more; after convergence the sum is at most that and hardly less.
    """
    fitted, predictions = _fit_small(spark, folder, max_iter=300)
    cost = float(fitted.model.summary.trainingCost)
    return _nearest(predictions, fitted.model).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_nearest").alias("n_nearest"),
        F.sum("own").between(0.999 * cost, cost * (1 + 1e-9)).alias("cost_matches"),
    )


@query("kmeans_centers", over_health("""
, width AS (SELECT count(DISTINCT measure_name) + 3 AS n FROM hv)
SELECT CAST(c AS INTEGER) AS cluster, CAST(s AS INTEGER) AS slot, true AS is_member_mean
FROM range(5) a(c), (SELECT unnest(range(n)) AS s FROM width) b"""))
def kmeans_centers(spark: SparkSession, folder: str) -> DataFrame:
    """Every slot of every centre, after convergence: is it the mean of the rows assigned to it?"""
    fitted, predictions = _fit_small(spark, folder, max_iter=300)
    slots = predictions.select(F.col("prediction").alias("cluster"), F.posexplode(vector_to_array("features")).alias("slot", "v"))
    means = slots.groupBy("cluster", "slot").agg(F.avg("v").alias("mean"))
    close = F.abs(F.col("value") - F.col("mean")) <= 0.01 * F.greatest(F.lit(1.0), F.abs("mean"))
    centers = clustering.center_rows(fitted.model, spark).join(means, ["cluster", "slot"], "left")
    return centers.select("cluster", "slot", F.coalesce(close, F.lit(False)).alias("is_member_mean"))


@query("kmeans_silhouette", over_health("""
SELECT count(*) AS n_rows, true AS same_as_evaluator FROM hv WHERE measure_name IS NOT NULL"""))
def kmeans_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    """The closed form over the feature slots against the built-in evaluator."""
    _, predictions = _fit_small(spark, folder)
    score = clustering.silhouette_of(predictions)
    rows_ = predictions.select(F.col("prediction").alias("cluster"), vector_to_array("features").alias("x"))
    scored = metrics.silhouette_rows(rows_, "x")
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.abs(F.avg("silhouette") - F.lit(score)) < 1e-6).alias("same_as_evaluator"),
    )


@query("kmeans_weighted", over_health("""
SELECT count(*) AS n_rows, true AS same_cost FROM hv WHERE measure_name IS NOT NULL"""))
def kmeans_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """One scaled one-hot block costs the same as the block repeated five times."""
    source = _health(spark, folder)
    cfg = KMeansConfig.unweighted(weight=5)
    scaled = clustering.fit_kmeans(source, cfg)
    repeated = clustering.fit_kmeans(source, replace(cfg, weighting="repeated"))
    a, b = scaled.model.summary.trainingCost, repeated.model.summary.trainingCost
    return clustering.prepare(source, scaled, cfg).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "same_cost", F.lit(abs(a - b) <= 1e-6 * max(1.0, a))
    )


# Fixed first centres of ``kmeans_wide_steps``: (part, quantity, discount in percent).
_WIDE_START = [("1", 10.0, 2.0), ("2", 25.0, 5.0), ("3", 40.0, 8.0)]


def _turn_sql(n: int, previous: str) -> str:
    """CTEs of one turn: rows to their nearest centre, then shares, means and squared norms."""
    return f"""
, near{n} AS (
  SELECT id, part, q, d, cluster FROM (
    SELECT r.*, m.cluster, row_number() OVER (PARTITION BY r.id ORDER BY
      (r.q - m.q) * (r.q - m.q) + (r.d - m.d) * (r.d - m.d) + 5 * (1 + m.norm - 2 * coalesce(s.share, 0)), m.cluster) AS place
    FROM rows_ r CROSS JOIN means{previous} m LEFT JOIN shares{previous} s ON s.part = r.part AND s.cluster = m.cluster)
  WHERE place = 1
), sizes{n} AS (SELECT cluster, count(*) AS n, avg(q) AS q, avg(d) AS d FROM near{n} GROUP BY cluster
), shares{n} AS (
  SELECT cluster, part, count(*) / any_value(z.n) AS share FROM near{n} JOIN sizes{n} z USING (cluster) GROUP BY cluster, part
), means{n} AS (
  SELECT cluster, any_value(z.q) AS q, any_value(z.d) AS d, sum(share * share) AS norm
  FROM shares{n} JOIN sizes{n} z USING (cluster) GROUP BY cluster
)"""


@query("kmeans_wide_steps", """
WITH rows_ AS (
  SELECT row_number() OVER () AS id, CAST(l_partkey AS VARCHAR) AS part, CAST(l_quantity AS DOUBLE) AS q,
         round(CAST(l_discount AS DOUBLE) * 100) AS d FROM lineitem WHERE l_partkey IS NOT NULL
), means0(cluster, q, d, norm) AS (VALUES """ + ", ".join(
    f"({i}, CAST({q} AS DOUBLE), CAST({d} AS DOUBLE), 1.0::DOUBLE)" for i, (_, q, d) in enumerate(_WIDE_START)) + """
), shares0(cluster, part, share) AS (VALUES """ + ", ".join(f"({i}, '{p}', 1.0::DOUBLE)" for i, (p, _, _) in enumerate(_WIDE_START)) + """
)""" + _turn_sql(1, "0") + _turn_sql(2, "1") + """
, ranks AS (SELECT part, row_number() OVER (ORDER BY count(*) DESC, part) - 1 AS slot FROM rows_ GROUP BY part)
SELECT CAST(cluster AS INTEGER) AS cluster, slot, round(share * sqrt(5), 6) AS value FROM shares2 JOIN ranks USING (part)
UNION ALL SELECT CAST(cluster AS INTEGER), (SELECT count(*) FROM ranks), round(q, 6) FROM means2
UNION ALL SELECT CAST(cluster AS INTEGER), (SELECT count(*) FROM ranks) + 1, round(d, 6) FROM means2""")
def kmeans_wide_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Two turns from given centres over all line items, with the part as category: every set slot of every centre."""
    source = table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("part"), F.col("l_quantity").cast("double").alias("q"),
        F.round(F.col("l_discount").cast("double") * 100).alias("d"),
    )
    cfg = KMeansConfig(k=len(_WIDE_START), max_iter=2, category="part", numeric=["q", "d"])
    fitted = wide_clustering.fit_wide(source, cfg, [(p, [q, d]) for p, q, d in _WIDE_START], tol=0.0)
    return wide_clustering.wide_center_rows(fitted).withColumn("value", F.round("value", 6))


@query("kmeans_wide_groups", """
SELECT row_number() OVER (ORDER BY l_suppkey % 3) AS place, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_categories,
       round(avg(1000 * (l_suppkey % 3) + CAST(l_quantity AS DOUBLE)), 6) AS mean
FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_suppkey % 3""")
def kmeans_wide_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Three groups far apart, with the order as category: drawn centres end as the groups' means."""
    number = 1000 * (F.col("l_suppkey") % 3) + F.col("l_quantity").cast("double")
    source = table(spark, folder, "lineitem").select("l_orderkey", number.alias("x"))
    fitted = wide_clustering.fit_wide(source, KMeansConfig.unweighted(k=3, category="l_orderkey", numeric=["x"]))
    held = {r["cluster"]: r["count"] for r in fitted.shares.groupBy("cluster").count().collect()}
    order = sorted(range(len(fitted.centers)), key=lambda i: fitted.centers[i])
    rows_ = [(n + 1, fitted.sizes[i], held[i], fitted.centers[i][0]) for n, i in enumerate(order)]
    found = spark.createDataFrame(rows_, "place bigint, n_rows bigint, n_categories bigint, mean double")
    return found.withColumn("mean", F.round("mean", 6))


@query("kmeans_infer_rows", """
SELECT *, true AS is_nearest FROM (VALUES """ + ", ".join(f"('{m}', {n}::BIGINT, {n + 7}::BIGINT, {n + 5}::BIGINT)" for m, n in clustering.PROBES) + """)
AS t(measure_name, value, lower_ci, upper_ci)""")
def kmeans_infer_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The seven probe rows through a model trained on the health rows; their measures are new to it."""
    fitted = clustering.fit_kmeans(_health(spark, folder), KMeansConfig())
    probes = clustering.infer(clustering.probe_rows(spark), fitted)
    return _nearest(probes, fitted.model).select("measure_name", *_NUMBERS, "is_nearest")


@query("model_roundtrip", over_health("""
SELECT count(*) AS n_rows, count(*) AS n_same FROM hv WHERE measure_name IS NOT NULL"""))
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows, with NULL and NaN, prepared and assigned by the saved and reloaded model as before."""
    cfg = KMeansConfig.unweighted()
    source = _health(spark, folder)
    fitted = clustering.fit_kmeans(source, cfg)
    base = scratch_path(spark, "model")
    clustering.save_fitted(fitted, base)
    loaded = clustering.load_fitted(base)
    before, after = (
        clustering.infer(clustering.prepare(source, f, cfg), f).select("id", F.col("prediction").alias(name))
        for f, name in ((fitted, "before"), (loaded, "after"))
    )
    return before.join(after, "id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") == F.col("after")).alias("n_same")
    )


@query("cluster_summary_totals", over_health("," + IMPUTED_SQL + """
SELECT count(*) AS n_rows, round(avg(value), 4) AS value, round(avg(lower_ci), 4) AS lower_ci, round(avg(upper_ci), 4) AS upper_ci,
  true AS first_is_known FROM clean"""))
def cluster_summary_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The clusters of the flagship query add up to the imputed rows; a single row is assigned to one of them."""
    cfg = KMeansConfig()
    source = _health(spark, folder)
    result = health_clustering.cluster(source, cfg)
    summary = freeze(health_clustering.summarize(result.predictions), "summary")
    known = {r["cluster"] for r in summary.select("cluster").collect()}
    first, _ = clustering.infer_row(spark, result.fitted)
    weighted = [F.round(F.sum(F.col("n") * F.col(f"avg_{c}")) / F.sum("n"), 4).alias(c) for c in _NUMBERS]
    return summary.agg(F.sum("n").alias("n_rows"), *weighted).withColumn("first_is_known", F.lit(first in known))


# --- metrics --------------------------------------------------------------------------

_POINTS = """
WITH s AS (SELECT event_id, value AS x, value * 2 + user_id AS y, value * 0.9 + 1 AS x_hat,
  value * 2 + user_id % 7 AS y_hat FROM events)
"""


def _points(spark: SparkSession, folder: str) -> DataFrame:
    v, u = F.col("value"), F.col("user_id")
    return table(spark, folder, "events").select(
        v.alias("x"), (v * 2 + u).alias("y"), (v * 0.9 + 1).alias("x_hat"), (v * 2 + u % 7).alias("y_hat")
    )


@query("metric_mae", _POINTS + "SELECT round(avg((abs(x_hat - x) + abs(y_hat - y)) / 2), 6) AS mae FROM s")
def metric_mae(spark: SparkSession, folder: str) -> DataFrame:
    error = metrics.mean_absolute_error(_points(spark, folder), [("x_hat", "x"), ("y_hat", "y")])
    return error.select(F.round("mae", 6).alias("mae"))


@query("metric_mse", _POINTS + """
SELECT round(avg(((x_hat - x) * (x_hat - x) + (y_hat - y) * (y_hat - y)) / 2), 6) AS mse FROM s""")
def metric_mse(spark: SparkSession, folder: str) -> DataFrame:
    error = metrics.mean_squared_error(_points(spark, folder), [("x_hat", "x"), ("y_hat", "y")])
    return error.select(F.round("mse", 6).alias("mse"))


_PROBABILITIES = """
WITH w AS (SELECT event_id, event_id % 3 AS label, CAST(event_id % 7 AS DOUBLE) AS a,
  1.0 + event_id % 5 AS b, 1.0 + event_id % 11 AS c FROM events),
p AS (SELECT label, a / (a + b + c) AS p0, b / (a + b + c) AS p1, c / (a + b + c) AS p2 FROM w)
"""


def _probabilities(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    weights = F.array((e % 7).cast("double"), (e % 5 + 1).cast("double"), (e % 11 + 1).cast("double"))
    total = (e % 7 + e % 5 + e % 11 + 2).cast("double")
    return table(spark, folder, "events").select(
        (e % 3).alias("label"), F.transform(weights, lambda w: w / total).alias("p")
    )


@query("metric_accuracy", _PROBABILITIES + """
SELECT round(avg(CASE WHEN label = CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END
  THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM p""")
def metric_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    scored = metrics.classification_metrics(_probabilities(spark, folder), "p", "label")
    return scored.select(F.round("accuracy", 6).alias("accuracy"), "n")


@query("metric_log_loss", _PROBABILITIES + """
SELECT round(avg(-ln(least(greatest(CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1e-7), 1 - 1e-7))), 6)
  AS log_loss, count(*) AS n FROM p""")
def metric_log_loss(spark: SparkSession, folder: str) -> DataFrame:
    scored = metrics.classification_metrics(_probabilities(spark, folder), "p", "label")
    return scored.select(F.round("log_loss", 6).alias("log_loss"), "n")


@query("epoch_mean_loss", """
SELECT event_id % 10 AS epoch, round(avg(value), 6) AS loss FROM events GROUP BY 1""")
def epoch_mean_loss(spark: SparkSession, folder: str) -> DataFrame:
    steps = table(spark, folder, "events").select((F.col("event_id") % 10).alias("epoch"), F.col("value").alias("loss"))
    return metrics.epoch_means(steps, "epoch", ["loss"]).select("epoch", F.round("loss", 6).alias("loss"))


DAILY_SQL = """
WITH daily AS (SELECT CAST(dayofyear(ts) AS INTEGER) AS epoch, round(avg(value), 6) AS loss,
  round(avg(abs(value - 50)), 6) AS mae, round(avg((value - 50) * (value - 50)), 6) AS mse
  FROM events GROUP BY 1),
history AS (SELECT epoch, 'loss' AS metric, loss AS value FROM daily
  UNION ALL SELECT epoch, 'mae', mae FROM daily UNION ALL SELECT epoch, 'mse', mse FROM daily)
"""


@query("history_last_best", DAILY_SQL + """
SELECT metric, arg_max(value, epoch) AS last_value, min(value) AS best_value,
  arg_min(epoch, value) AS best_epoch FROM history GROUP BY metric""")
def history_last_best(spark: SparkSession, folder: str) -> DataFrame:
    daily = derived_inputs.daily_metrics(spark, folder)
    summary = metrics.history_summary(metrics.history_long(daily, "epoch", ["loss", "mae", "mse"]))
    return summary.select("metric", "last_value", "best_value", "best_epoch")


# --- supervised training and prediction -----------------------------------------------

_TRAINED: dict[tuple[str, str], supervised.TrainedClassifier] = {}


def _trained(spark: SparkSession, folder: str) -> supervised.TrainedClassifier:
    """The classifier over the health rows, trained once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TRAINED:
        _TRAINED[key] = supervised.train_classifier(health_view(spark, folder), "id")
    return _TRAINED[key]


_HELD_OUT = """
, c AS (SELECT count(*) AS n, count(DISTINCT trim(subpopulation)) AS classes FROM hv
  WHERE trim(subpopulation) <> '' AND value IS NOT NULL AND NOT isnan(value)
    AND lower_ci IS NOT NULL AND upper_ci IS NOT NULL),
h AS (SELECT greatest(1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT)) AS held, classes FROM c)
"""


@query("classifier_eval", over_health(_HELD_OUT + "SELECT held AS n, true AS accuracy_matches, true AS log_loss_matches FROM h"))
def classifier_eval(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluated metrics against those recomputed from the written probabilities."""
    trained = _trained(spark, folder)
    told = supervised.evaluate_classifier(trained).first()
    scored = supervised.predict_probabilities(trained.validation, trained.model)
    written = freeze(scored.select("label_idx", "probabilities"), "probabilities")
    own = F.element_at("probabilities", F.col("label_idx").cast("int") + 1)
    hit = (F.array_position("probabilities", F.array_max("probabilities")) == F.col("label_idx").cast("int") + 1).cast("double")
    loss = -F.log(F.greatest(F.least(own, F.lit(1 - 1e-7)), F.lit(1e-7)))
    return written.agg(
        F.count(F.lit(1)).alias("n"), (F.abs(F.avg(hit) - F.lit(told["accuracy"])) < 1e-9).alias("accuracy_matches"),
        (F.abs(F.avg(loss) - F.lit(told["log_loss"])) < 1e-9).alias("log_loss_matches"),
    )


@query("history_long", "SELECT 1 AS first_epoch, 0::BIGINT AS gaps, 0::BIGINT AS rising, true AS loss_fell")
def history_long(spark: SparkSession, folder: str) -> DataFrame:
    """Training loss per iteration of the classifier, written, read back and checked for gaps and rises."""
    from pyspark.sql import Window

    from orrery.sinks.files import write_history

    losses = [(i + 1, "loss", float(v)) for i, v in enumerate(_trained(spark, folder).history)]
    path = scratch_path(spark, "history")
    write_history(spark.createDataFrame(losses, "epoch int, metric string, value double"), path)
    epochs = Window.partitionBy("metric").orderBy("epoch")
    read = spark.read.schema("epoch int, metric string, value double").json(path)
    steps = read.withColumns({"gap": F.col("epoch") - F.lag("epoch").over(epochs), "rise": F.col("value") - F.lag("value").over(epochs)})
    return steps.agg(
        F.min("epoch").alias("first_epoch"), F.count_if(F.col("gap") != 1).alias("gaps"), F.count_if(F.col("rise") > 1e-9).alias("rising"),
        (F.min_by("value", "epoch") > F.max_by("value", "epoch")).alias("loss_fell"),
    )


def _regression_rows(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("embedding")
    rows_ = table(spark, folder, "embeddings").select(
        "vec_id", e[0].cast("double").alias("x_px"), e[1].cast("double").alias("y_px"),
        F.transform(F.slice(e, 3, 62), lambda v: v.cast("double")).alias("x"),
    )
    return encode.feature_vector(rows_, "x")


@query("regressor_eval", """
WITH n AS (SELECT count(*) AS n FROM embeddings)
SELECT CAST(s AS INTEGER) AS slot, greatest(1, least(n - 1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT))) AS n_validation,
  true AS normal_x, true AS normal_y FROM n, range(62) t(s)""")
def regressor_eval(spark: SparkSession, folder: str) -> DataFrame:
    """Each feature against the training residuals of both targets: the normal equations hold."""
    training, validation = rows.holdout_split(_regression_rows(spark, folder), "vec_id", 0.2, clamp_to_rest=True)
    regressor = supervised.train_point_regressor(training)
    n = supervised.evaluate_regressor(validation, regressor).first()["n"]
    fitted = supervised.predict_points(training, regressor)
    slots = fitted.select("*", F.posexplode(vector_to_array("features")).alias("slot", "v"))
    sums = slots.groupBy("slot").agg(*[
        (F.abs(F.sum(F.col("v") * (F.col(f"{t}_px") - F.col(f"{t}_px_hat")))) < 1e-6).alias(f"normal_{t}") for t in ("x", "y")
    ])
    return sums.select("slot", F.lit(n).cast("bigint").alias("n_validation"), "normal_x", "normal_y")


@query("saved_regressor_predictions", "SELECT count(*) AS n_pictures, count(*) AS n_same FROM embeddings")
def saved_regressor_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Trained on pictures, saved, loaded: the predictions of both regressors for every picture."""
    pictures = derived_inputs.pictures(spark, folder)
    pixels = images.image_features(pictures, 4, 4, keep=("vec_id",))
    points = encode.feature_vector(pixels, "pixels").select(
        "origin", "features", (F.col("vec_id") % 320).cast("double").alias("x_px"), (F.col("vec_id") % 256).cast("double").alias("y_px")
    )
    regressor = supervised.train_point_regressor(points, reg=0.01)
    base = scratch_path(spark, "regressor")
    supervised.save_regressor(regressor, base)
    load = supervised.regressor_loader(supervised.load_regressor(base))
    after = images.image_predictions(pictures, load, 4, 4).withColumnsRenamed({"x_px": "x", "y_px": "y"})
    both = supervised.predict_points(points, regressor).join(after, "origin")
    same = (F.abs(F.col("x_px_hat") - F.col("x")) < 1e-4) & (F.abs(F.col("y_px_hat") - F.col("y")) < 1e-4)
    return both.agg(F.count(F.lit(1)).alias("n_pictures"), F.count_if(same).alias("n_same"))


_SPLIT_SQL = """
WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
    CAST(embedding[3] AS DOUBLE) AS f, count(*) OVER () AS n,
    row_number() OVER (ORDER BY md5(concat('1337:', CAST(vec_id AS VARCHAR))), vec_id) - 1 AS place FROM embeddings),
s AS (SELECT *, place >= n - greatest(1, least(n - 1, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT))) AS held FROM p),
c AS (SELECT regr_slope(x, f) AS bx, regr_intercept(x, f) AS ax, regr_slope(y, f) AS by_, regr_intercept(y, f) AS ay
  FROM s WHERE NOT held)
"""


@query("regressor_fit_check", _SPLIT_SQL + """
SELECT round(avg((abs(ax + bx * f - x) + abs(ay + by_ * f - y)) / 2), 6) AS mae,
  round(avg((pow(ax + bx * f - x, 2) + pow(ay + by_ * f - y, 2)) / 2), 6) AS mse, count(*) AS n
FROM s CROSS JOIN c WHERE held""")
def regressor_fit_check(spark: SparkSession, folder: str) -> DataFrame:
    """Split, fit and score with a single feature, where SQL knows the least-squares line."""
    e = F.col("embedding")
    points = encode.feature_vector(
        table(spark, folder, "embeddings").select(
            "vec_id", e[0].cast("double").alias("x_px"), e[1].cast("double").alias("y_px"),
            F.array(e[2].cast("double")).alias("x"),
        ), "x",
    )
    training, validation = rows.holdout_split(points, "vec_id", 0.2, clamp_to_rest=True)
    scored = supervised.evaluate_regressor(validation, supervised.train_point_regressor(training))
    return scored.select(F.round("mae", 6).alias("mae"), F.round("mse", 6).alias("mse"), "n")


@query("joint_regressor_check", _SPLIT_SQL + """
SELECT round(avg((abs(ax + bx * f - x) + abs(ay + by_ * f - y)) / 2), 6) AS mae,
  round(avg((pow(ax + bx * f - x, 2) + pow(ay + by_ * f - y, 2)) / 2), 6) AS mse, count(*) AS n
FROM s CROSS JOIN c WHERE held""")
def joint_regressor_check(spark: SparkSession, folder: str) -> DataFrame:
    """Both targets in one scan an epoch, where SQL knows the two least-squares lines."""
    e = F.col("embedding")
    points = table(spark, folder, "embeddings").select(
        "vec_id", e[0].cast("double").alias("x_px"), e[1].cast("double").alias("y_px"), F.array(e[2]).alias("x"))
    training, validation = rows.holdout_split(points, "vec_id", 0.2, clamp_to_rest=True)
    net = networks.train_linear(networks.pack(training, "vec_id", "x", ["x_px", "y_px"], 4096))
    scored = validation.withColumn("p", networks.predict_column(F.col("x"), net))
    scored = scored.select("x_px", "y_px", F.col("p")[0].alias("x_hat"), F.col("p")[1].alias("y_hat"))
    told = metrics.regression_metrics(scored, [("x_hat", "x_px"), ("y_hat", "y_px")])
    return told.select(F.round("mae", 6).alias("mae"), F.round("mse", 6).alias("mse"), "n")


@query("network_one_step", """
WITH r AS (SELECT label, unnest([1.0::DOUBLE, embedding[1]::DOUBLE, embedding[2]::DOUBLE, embedding[3]::DOUBLE]) AS v,
    unnest([3, 0, 1, 2]) AS slot FROM embeddings WHERE label IS NOT NULL)
SELECT CAST(slot AS INTEGER) AS slot, CAST(k AS INTEGER) AS class, round(-0.5 * avg(v * (0.1 - CASE WHEN label = k THEN 1 ELSE 0 END)), 7) AS weight
FROM r CROSS JOIN range(10) t(k) GROUP BY slot, k""")
def network_one_step(spark: SparkSession, folder: str) -> DataFrame:
    """One gradient step over all rows from a softmax layer of zeros: SQL knows every weight (slot 3 is the bias)."""
    e = F.col("embedding")
    known = table(spark, folder, "embeddings").filter(F.col("label").isNotNull()).select("vec_id", F.slice(e, 1, 3).alias("x"), "label")
    zero = networks.Network([(np.zeros((3, 10)), np.zeros(10))], np.zeros(3), np.ones(3), True)
    cfg = networks.TrainingConfig(hidden=(), learning_rate=0.5, optimizer="plain", standardize=False)
    net = networks.train_network(networks.pack(known, "vec_id", "x", ["label"], 1 << 40), 10, True, cfg, start=zero)
    (w, b), = net.layers
    told = [(j, k, float(v)) for j, line in enumerate([*w, b]) for k, v in enumerate(line)]
    return spark.createDataFrame(told, "slot int, class int, weight double").withColumn("weight", F.round("weight", 7))


@query("network_history", """
SELECT CAST(epoch AS INTEGER) AS epoch, metric, true AS plausible, true AS loss_fell FROM range(1, 4) t(epoch)
CROSS JOIN (SELECT unnest(['loss', 'accuracy', 'val_loss', 'val_accuracy']) AS metric)""")
def network_history(spark: SparkSession, folder: str) -> DataFrame:
    """Loss and accuracy of training and validation rows after each of three epochs of Adam steps."""
    encoded, vocab = supervised.labelled_rows(health_view(spark, folder))
    n = encoded.count()
    cfg = networks.TrainingConfig(epochs=3, batch_size=-(-n // 12), learning_rate=0.01)
    net = supervised_training.train_labelled_network(encoded, vocab, "id", list(clean.NUMERIC_COLUMNS), cfg)
    told = networks.history_rows(spark, net.history)
    low = F.when(F.col("metric").endswith("accuracy"), F.col("value").between(0, 1)).otherwise(F.col("value") > 0)
    return told.select("epoch", "metric", low.alias("plausible"), F.lit(net.history[-1]["loss"] < net.history[0]["loss"]).alias("loss_fell"))


@query("classifier_check", over_health(_HELD_OUT + "SELECT held AS n_rows, held AS n_sum_one, classes FROM h"))
def classifier_check(spark: SparkSession, folder: str) -> DataFrame:
    """Exact hold-out size, one probability per class, probabilities that add up to one."""
    trained = _trained(spark, folder)
    scored = supervised.predict_probabilities(trained.validation, trained.model)
    total = F.aggregate("probabilities", F.lit(0.0), lambda acc, p: acc + p)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(total - 1) < 1e-9).alias("n_sum_one"),
        F.max(F.size("probabilities")).cast("bigint").alias("classes"),
    )


@query("batch_predict", """
WITH w AS (SELECT vec_id, embedding, range(1, 65) AS r FROM embeddings)
SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), list_transform(r, lambda i: i / 64.0::DOUBLE)) + 0.5, 5) AS x_px,
  round(list_dot_product(CAST(embedding AS DOUBLE[]), list_transform(r, lambda i: (65 - i) / 64.0::DOUBLE)) - 0.5, 5) AS y_px FROM w""")
def batch_predict(spark: SparkSession, folder: str) -> DataFrame:
    load = supervised.linear_predictor(
        [[i / 64 for i in range(1, 65)], [(65 - i) / 64 for i in range(1, 65)]], [0.5, -0.5]
    )
    scored = table(spark, folder, "embeddings").select(
        "vec_id", supervised.batch_predict(F.col("embedding"), load, 64).alias("p")
    )
    return scored.select("vec_id", F.round(F.col("p")[0], 5).alias("x_px"), F.round(F.col("p")[1], 5).alias("y_px"))


# --- images ---------------------------------------------------------------------------

# 8 x 8 pictures halved by half-pixel linear interpolation: means of 2 x 2 pixels.
_PIXELS_SQL = """
WITH px AS (SELECT vec_id, i - 1 AS i,
    least(greatest(CAST(floor(CAST(embedding[i] AS DOUBLE) * 127 + 128) AS BIGINT), 0), 255) AS g
  FROM embeddings CROSS JOIN range(1, 65) t(i)),
rgb AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, unnest([0, 1, 2]) AS ch,
    unnest([g * 3 % 256, 255 - g, g]) AS v FROM px),
half AS (SELECT vec_id, CAST(((y // 2) * 4 + x // 2) * 3 + ch AS INTEGER) AS slot,
    CAST(avg(v) / 255 AS FLOAT) AS value FROM rgb GROUP BY vec_id, y // 2, x // 2, ch)
"""


@query("image_features", _PIXELS_SQL + """
SELECT vec_id, slot, round(CAST(value AS DOUBLE), 5) AS value FROM half""")
def image_features(spark: SparkSession, folder: str) -> DataFrame:
    features = images.image_features(derived_inputs.pictures(spark, folder), 4, 4, keep=("vec_id",))
    slots = features.select("vec_id", F.posexplode("pixels").alias("slot", "v"))
    return slots.select("vec_id", "slot", F.round(F.col("v").cast("double"), 5).alias("value"))


def _tap_sums(target: int) -> str:
    """SQL for the total weight of each of 8 source rows or columns over ``target`` linear taps."""
    return f"""(SELECT place, sum(w) AS w FROM (
  SELECT unnest([greatest(0, least(7, floor(spot))), greatest(0, least(7, ceil(spot)))]) AS place,
    unnest([1 - (spot - floor(spot)), spot - floor(spot)]) AS w
  FROM (SELECT (t + 0.5) * 8.0 / {target} - 0.5 AS spot FROM range({target}) r(t))) GROUP BY place)"""


@query("image_features_full_size", f"""
WITH px AS (SELECT vec_id, i - 1 AS i, least(greatest(CAST(floor(CAST(embedding[i] AS DOUBLE) * 127 + 128) AS BIGINT), 0), 255) AS g
  FROM embeddings CROSS JOIN range(1, 65) t(i)),
rw AS {_tap_sums(256)}, cw AS {_tap_sums(320)}
SELECT vec_id, CAST(256 * 320 * 3 AS INTEGER) AS n_pixels,
  round(sum((g * 3 % 256 + 255 - g + g) / 255.0 * rw.w * cw.w) / (256 * 320 * 3), 4) AS mean_level
FROM px JOIN rw ON rw.place = i // 8 JOIN cw ON cw.place = i % 8 GROUP BY vec_id""")
def image_features_full_size(spark: SparkSession, folder: str) -> DataFrame:
    """Pictures at the size that training uses by default: number and mean of the features of each."""
    pictures = derived_inputs.pictures(spark, folder)
    # A megabyte of features comes of each row, so rows are spread by their number and not by the bytes read.
    parts = max(spark.sparkContext.defaultParallelism, -(-pictures.count() // PICTURES_PER_TASK))
    features = images.image_features(rows.spread(pictures, parts), 256, 320, keep=("vec_id",))
    total = F.aggregate("pixels", F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return features.select("vec_id", F.size("pixels").alias("n_pixels"), F.round(total / F.size("pixels"), 4).alias("mean_level"))


@query("image_predictions", _PIXELS_SQL + """
SELECT concat('vec_', CAST(vec_id AS VARCHAR), '.png') AS origin,
  round(sum(CAST(value AS DOUBLE) * (slot + 1)), 3) AS x_px, round(sum(CAST(value AS DOUBLE) * (48 - slot)), 3) AS y_px
FROM half GROUP BY vec_id""")
def image_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a fixed linear model over the pixels, written and read back."""
    load = supervised.linear_predictor([[float(i + 1) for i in range(48)], [float(48 - i) for i in range(48)]], [0.0, 0.0])
    path = scratch_path(spark, "image-predictions")
    write_image_predictions(images.image_predictions(derived_inputs.pictures(spark, folder), load, 4, 4), path)
    return spark.read.parquet(path).select("origin", F.round("x_px", 3).alias("x_px"), F.round("y_px", 3).alias("y_px"))
