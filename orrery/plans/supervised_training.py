"""Training jobs: labelled CSV to classifier, labelled image folder to point regressor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from orrery.functions.text import image_pattern
from orrery.operators import networks, supervised
from orrery.operators.clean import NUMERIC_COLUMNS
from orrery.operators.encode import feature_vector
from orrery.operators.images import image_features
from orrery.operators.metrics import history_long
from orrery.operators.rows import dense_index, holdout_split
from orrery.runtime import freeze
from orrery.sinks.files import write_history, write_label_map
from orrery.sources.delimited import Multiline, read_csv_rows
from orrery.sources.image_files import unreadable_images
from orrery.sources.labels import read_image_dataset
from orrery.sources.rejects import ColumnCounts, Observed, features_observed, reject_rows


@dataclass(frozen=True)
class TrainingReport:
    metrics: dict[str, float]
    model_path: str
    history_path: str
    unreadable_pictures: int = 0
    #: Rows read, and for each column how many of its values were missing or no number.
    counts: ColumnCounts | None = None


def labelled_source(df: DataFrame, features: list[str] = NUMERIC_COLUMNS, label: str = "subpopulation") -> tuple[DataFrame, Observed]:
    """Rows numbered by ``row_id`` in one write, which also counts and lists what makes rows incomplete."""
    rows, seen = features_observed(df, features, label)
    return dense_index(rows, name="row_id"), seen


def train_classifier_from_csv(
    spark: SparkSession,
    path: str,
    output: str,
    features: list[str] = NUMERIC_COLUMNS,
    label: str = "subpopulation",
    max_iter: int = 100,
    multiline: Multiline = True,
) -> TrainingReport:
    """Read, validate, encode, split, train, evaluate; write model, label map, history and rejected values."""
    output = output.rstrip("/")
    source = read_csv_rows(spark, path, multiline=multiline)
    wanted = [c for c in [label, *features] if c in source.columns]
    numbered, seen = labelled_source(source.select(*wanted), features, label)
    reject_rows(numbered, "row_id").write.mode("overwrite").parquet(f"{output}/rejects")
    trained = supervised.train_classifier(numbered, "row_id", features, label, max_iter=max_iter)
    write_label_map(trained.vocab, label, "label_idx", f"{output}/label_map")
    trained.model.write().overwrite().save(f"{output}/model")
    losses = [(i + 1, "loss", float(v)) for i, v in enumerate(trained.history)]
    write_history(spark.createDataFrame(losses, "epoch int, metric string, value double"), f"{output}/history")
    return TrainingReport(
        supervised.evaluate_classifier(trained).first().asDict(), f"{output}/model", f"{output}/history", counts=seen.counts()
    )


def train_network_from_csv(
    spark: SparkSession,
    path: str,
    output: str,
    features: list[str] = NUMERIC_COLUMNS,
    label: str = "subpopulation",
    cfg: networks.TrainingConfig = networks.TrainingConfig(),
    fraction: float = 0.2,
    multiline: Multiline = True,
) -> TrainingReport:
    """Labelled CSV to a ReLU network by mini-batch steps; the history has training and validation metrics of every epoch.

    Writes network, label map, history and rejected values below ``output``.
    """
    output = output.rstrip("/")
    source = read_csv_rows(spark, path, multiline=multiline)
    numbered, seen = labelled_source(source.select(*[c for c in [label, *features] if c in source.columns]), features, label)
    reject_rows(numbered, "row_id").write.mode("overwrite").parquet(f"{output}/rejects")
    encoded, vocab = supervised.labelled_rows(numbered, features, label)
    write_label_map(vocab, label, "label_idx", f"{output}/label_map")
    net = train_labelled_network(encoded, vocab, "row_id", features, cfg, fraction)
    networks.save_network(spark, net, f"{output}/network")
    write_history(networks.history_rows(spark, net.history), f"{output}/history")
    return TrainingReport(net.history[-1] if net.history else {}, f"{output}/network", f"{output}/history", counts=seen.counts())


def train_labelled_network(encoded: DataFrame, vocab: DataFrame, key: str, features: list[str],
                           cfg: networks.TrainingConfig = networks.TrainingConfig(), fraction: float = 0.2) -> networks.Network:
    """A network over encoded rows, with an exact hold-out split by ``key`` for the validation metrics."""
    rows = encoded.select(key, "label_idx", F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    training, validation = holdout_split(freeze(rows, "labelled"), key, fraction, seed=cfg.seed)
    classes = int(vocab.agg(F.max("label_idx").alias("m")).first()["m"]) + 1
    blocks, held = (networks.pack(part, key, "x", ["label_idx"], cfg.batch_size, cfg.seed) for part in (training, validation))
    return networks.train_network(blocks, classes, True, cfg, held)


def train_points_jointly_from_folder(
    spark: SparkSession, folder: str, output: str, height: int = 256, width: int = 320,
    fraction: float = 0.2, reg: float = 0.01, epochs: int = 10, batch_size: int = 1024,
) -> TrainingReport:
    """Labelled pictures to one linear model of (x_px, y_px): one scan an epoch for both targets.

    The history has loss, MAE and MSE of the training and the validation pictures for the
    weights that each epoch began with, and those of the final weights as last entry.
    """
    output = output.rstrip("/")
    pixels = image_features(read_image_dataset(spark, folder), height, width, image="picture", keep=("image", "x_px", "y_px"))
    rows = freeze(pixels.select("image", "x_px", "y_px", "pixels"), "pixels")
    training, validation = holdout_split(rows, "image", fraction, clamp_to_rest=True)
    blocks, held = (networks.pack(part, "image", "pixels", ["x_px", "y_px"], batch_size) for part in (training, validation))
    net = networks.train_linear(blocks, epochs + 1, reg, validation=held)
    last = {"epoch": len(net.history) + 1, **networks.evaluate(net, blocks), **networks.evaluate(net, held, "val_")}
    net.history.append(last)
    networks.save_network(spark, net, f"{output}/network")
    write_history(networks.history_rows(spark, net.history), f"{output}/history")
    unreadable = unreadable_images(spark, folder, image_pattern()).count()
    return TrainingReport(last, f"{output}/network", f"{output}/history", unreadable)


def image_vectors(dataset: DataFrame, height: int, width: int) -> DataFrame:
    """(image, x_px, y_px, features): pixels of the resized picture as one vector."""
    pixels = image_features(dataset, height, width, image="picture", keep=("image", "x_px", "y_px"))
    return feature_vector(pixels, "pixels").select("image", "x_px", "y_px", "features")


def train_points_from_folder(
    spark: SparkSession, folder: str, output: str, height: int = 256, width: int = 320,
    fraction: float = 0.2, reg: float = 0.01,
) -> TrainingReport:
    """Labelled pictures to a regressor of (x_px, y_px); the targets stay in original pixels."""
    output = output.rstrip("/")
    # Pictures are decoded once; the split then reads the names only.
    rows = freeze(image_vectors(read_image_dataset(spark, folder), height, width), "pixels")
    training, validation = holdout_split(rows, "image", fraction, clamp_to_rest=True)
    regressor = supervised.train_point_regressor(training, reg=reg)
    supervised.save_regressor(regressor, output)
    scored = supervised.evaluate_regressor(validation, regressor)
    wide = scored.select(F.lit(1).alias("epoch"), "mae", "mse", F.col("mse").alias("loss"))
    write_history(history_long(wide, "epoch", ["loss", "mae", "mse"]), f"{output}/history")
    unreadable = unreadable_images(spark, folder, image_pattern()).count()
    return TrainingReport(scored.first().asDict(), f"{output}/model", f"{output}/history", unreadable)
