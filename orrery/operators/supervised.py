"""Classifier and point regressor training, evaluation, batch prediction."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from orrery.operators.clean import NUMERIC_COLUMNS, complete_cases, require_rows
from orrery.operators.encode import label_encode, vocabulary
from orrery.operators.metrics import classification_metrics, regression_metrics
from orrery.operators.rows import SEED, holdout_split, spread
from orrery.runtime import freeze

# Sizes of the hidden layers.
HIDDEN_LAYERS = [16, 32, 64]

# Rows stacked into one matrix by the network trainer.
BLOCK_ROWS = 1024
#: Rows of one partition of the trainer, which reads them some hundred times.
TRAINING_ROWS = 250_000


@dataclass(frozen=True)
class TrainedClassifier:
    model: PipelineModel
    vocab: DataFrame
    training: DataFrame
    validation: DataFrame
    history: list[float]


def labelled_rows(
    df: DataFrame, features: list[str] = NUMERIC_COLUMNS, label: str = "subpopulation"
) -> tuple[DataFrame, DataFrame]:
    """(encoded rows, vocabulary) of the complete, labelled rows."""
    rows = complete_cases(df, features, label)
    vocab = require_rows(vocabulary(rows, label, "label_idx"), "no valid rows in the dataset")
    return label_encode(rows, label, vocab=vocab), vocab


def train_classifier(
    df: DataFrame,
    key: str,
    features: list[str] = NUMERIC_COLUMNS,
    label: str = "subpopulation",
    fraction: float = 0.2,
    max_iter: int = 100,
    seed: int = SEED,
) -> TrainedClassifier:
    """Dense network over the numeric features with an exact hold-out split.

    Inputs are standardised because the network's hidden units are sigmoids.
    """
    encoded, vocab = labelled_rows(df, features, label)
    # One narrow copy serves the split's key-only passes, training and evaluation.
    encoded = freeze(encoded.select(key, "label_idx", *features), "labelled")
    training, validation = holdout_split(encoded, key, fraction, seed=seed)
    classes = int(vocab.agg(F.max("label_idx").alias("m")).first()["m"]) + 1
    stages = Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
    ])
    # The narrow copy is a few small files; every core takes part in each turn over it.
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-training.count() // TRAINING_ROWS))
    spread_out = spread(training, parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prepared = stages.fit(spread_out)
        network = MultilayerPerceptronClassifier(
            layers=[len(features), *HIDDEN_LAYERS, max(2, classes)], labelCol="label_idx",
            maxIter=max_iter, seed=seed, blockSize=BLOCK_ROWS,
        ).fit(prepared.transform(spread_out))
    finally:
        spread_out.unpersist()
    model = PipelineModel([*prepared.stages, network])
    return TrainedClassifier(model, vocab, training, validation, list(network.summary().objectiveHistory))


def predict_probabilities(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df).withColumn("probabilities", vector_to_array("probability"))


def evaluate_classifier(trained: TrainedClassifier) -> DataFrame:
    """Validation accuracy and cross-entropy."""
    scored = predict_probabilities(trained.validation, trained.model)
    return classification_metrics(scored, "probabilities", "label_idx")


@dataclass(frozen=True)
class PointRegressor:
    x: LinearRegressionModel
    y: LinearRegressionModel


def train_point_regressor(df: DataFrame, features: str = "features", targets: tuple[str, str] = ("x_px", "y_px"),
                          reg: float = 0.0) -> PointRegressor:
    """Least-squares regressor of both pixel coordinates on one feature vector."""
    rows = df.select(features, *targets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = [LinearRegression(featuresCol=features, labelCol=t, regParam=reg, predictionCol=f"{t}_hat").fit(rows)
               for t in targets]
    finally:
        rows.unpersist()
    return PointRegressor(*fit)


def predict_points(df: DataFrame, regressor: PointRegressor) -> DataFrame:
    return regressor.y.transform(regressor.x.transform(df))


def evaluate_regressor(df: DataFrame, regressor: PointRegressor, targets: tuple[str, str] = ("x_px", "y_px")) -> DataFrame:
    scored = predict_points(df, regressor)
    return regression_metrics(scored, [(f"{t}_hat", t) for t in targets])


def save_regressor(regressor: PointRegressor, base: str) -> None:
    """Write both models below ``base``, replacing earlier ones."""
    for name, model in (("x", regressor.x), ("y", regressor.y)):
        model.write().overwrite().save(f"{base.rstrip('/')}/model_{name}")


def load_regressor(base: str) -> PointRegressor:
    return PointRegressor(*[LinearRegressionModel.load(f"{base.rstrip('/')}/model_{name}") for name in ("x", "y")])


def load_classifier(base: str) -> PipelineModel:
    """The classifier that ``train_classifier_from_csv`` wrote below ``base``."""
    return PipelineModel.load(f"{base.rstrip('/')}/model")


def regressor_loader(regressor: PointRegressor) -> Callable:
    """A fitted regressor as the loader that batch prediction takes."""
    models = (regressor.x, regressor.y)
    return linear_predictor([m.coefficients.toArray().tolist() for m in models], [m.intercept for m in models])


def linear_predictor(weights: list[list[float]], bias: list[float]) -> Callable:
    """Loader of a small linear model, run once per Python worker."""

    def load():
        w, b = np.asarray(weights, dtype=np.float64), np.asarray(bias, dtype=np.float64)

        def predict(batch: np.ndarray) -> np.ndarray:
            return batch.astype(np.float64) @ w.T + b

        return predict

    return load


def batch_predict(features: Column, load: Callable, width: int, batch_size: int = 1024) -> Column:
    """Predictions of an opaque model over Arrow batches; the model loads once per worker."""
    udf = predict_batch_udf(
        load, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[width]]
    )
    return udf(features)
