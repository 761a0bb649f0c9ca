"""Jobs for spark-submit: ``spark-submit run_job.py <job> [options]``.

Options take their defaults from the environment variables named in the help.
The session comes from spark-submit; nothing about the cluster is set here.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from orrery.operators.clustering import KMeansConfig, center_rows, infer, probe_rows
from orrery.operators.networks import TrainingConfig, load_network, predictor
from orrery.operators.supervised import load_regressor, regressor_loader
from orrery.plans import health_clustering, load_health, supervised_training
from orrery.plans.image_inference import predict_folder
from orrery.runtime import clear_scratch, path_exists
from orrery.sources.jdbc import JdbcConfig, KeyRange, read_jdbc
from orrery.sources.paths import data_path


# Words that switch an option on, and the environment variables named below.
def _yes(text: str) -> bool:
    return text.strip().lower() in ("1", "true", "yes", "y")


def _env(name: str, default: str = "") -> str:
    return os.environ.get(name, default)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="run_job.py", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(dest="job", required=True)

    show = jobs.add_parser("show-table", help="read a database table, print schema and rows")
    show.add_argument("--rows", type=int, default=50)

    table = jobs.add_parser("cluster-table", help="database table to weighted clusters (DB_*, MEASURE_NAME_WEIGHT)")
    table.add_argument("--k", type=int, default=25)
    table.add_argument("--max-iter", type=int, default=1000)
    table.add_argument("--split", choices=["derived", "balanced", "fixed", "none"], default="derived",
                       help="parts of the read; fixed: ids 1 to 1,000,000 in 16 parts")
    table.add_argument("--probe", type=_yes, default=_yes(_env("RUN_INFERENCE", "true")), help="RUN_INFERENCE")
    table.add_argument("--save-to", default=_env("MODEL_OUTPUT_DIR") or None, help="MODEL_OUTPUT_DIR")

    file = jobs.add_parser("cluster-csv", help="CSV to clusters with silhouette (GCP_PROJECT_ID when no path is given)")
    file.add_argument("--path")
    file.add_argument("--k", type=int, default=5)
    file.add_argument("--infer-types", action="store_true")
    file.add_argument("--no-multiline", dest="multiline", action="store_false", help="no line breaks inside quotes: spares a pass")
    file.add_argument("--save-to", default=_env("MODEL_OUTPUT_DIR") or None, help="MODEL_OUTPUT_DIR")

    load = jobs.add_parser("load-csv", help="CSV to a catalog table, or to a database with --jdbc (DB_*)")
    load.add_argument("--path", required=True)
    load.add_argument("--table", default="health_disparities")
    load.add_argument("--database", default="health_data")
    load.add_argument("--location")
    load.add_argument("--jdbc", action="store_true")
    load.add_argument("--batch-size", type=int, default=1000)
    load.add_argument("--no-multiline", dest="multiline", action="store_false")

    train = jobs.add_parser("train-csv", help="labelled CSV to classifier (DATA_PATH, OUTPUT_DIR)")
    train.add_argument("--data-path", default=_env("DATA_PATH"), help="DATA_PATH")
    train.add_argument("--output-dir", default=_env("OUTPUT_DIR", "./model"), help="OUTPUT_DIR")
    train.add_argument("--max-iter", type=int, default=100)
    train.add_argument("--no-multiline", dest="multiline", action="store_false")

    pictures = jobs.add_parser("train-images", help="labelled image folder to point regressor (DATA_PATH, OUTPUT_DIR)")
    pictures.add_argument("--data-path", default=_env("DATA_PATH"), help="DATA_PATH")
    pictures.add_argument("--output-dir", default=_env("OUTPUT_DIR", "./model"), help="OUTPUT_DIR")
    pictures.add_argument("--img-height", type=int, default=int(_env("IMG_HEIGHT", "256")), help="IMG_HEIGHT")
    pictures.add_argument("--img-width", type=int, default=int(_env("IMG_WIDTH", "320")), help="IMG_WIDTH")

    either = jobs.add_parser("train", help="labelled CSV to a ReLU network, or labelled pictures to a joint point model (DATA_PATH, OUTPUT_DIR, EPOCHS, BATCH_SIZE)")
    either.add_argument("--data-path", default=_env("DATA_PATH"), help="DATA_PATH")
    either.add_argument("--data-is-images", action="store_true", help="the data path is a picture folder with its label file")
    either.add_argument("--output-dir", default=_env("OUTPUT_DIR", "./model"), help="OUTPUT_DIR")
    either.add_argument("--epochs", type=int, default=int(_env("EPOCHS", "1")), help="EPOCHS")
    either.add_argument("--batch-size", type=int, default=int(_env("BATCH_SIZE", "32")), help="BATCH_SIZE")
    either.add_argument("--learning-rate", type=float, default=1e-3)
    either.add_argument("--img-height", type=int, default=int(_env("IMG_HEIGHT", "256")), help="IMG_HEIGHT")
    either.add_argument("--img-width", type=int, default=int(_env("IMG_WIDTH", "320")), help="IMG_WIDTH")

    predict = jobs.add_parser("predict-images", help="saved point regressor to the positions in a picture folder")
    predict.add_argument("--data-path", default=_env("DATA_PATH"), help="DATA_PATH")
    predict.add_argument("--model-dir", default=_env("OUTPUT_DIR", "./model"), help="OUTPUT_DIR of train or train-images")
    predict.add_argument("--output", required=True)
    predict.add_argument("--img-height", type=int, default=int(_env("IMG_HEIGHT", "256")), help="IMG_HEIGHT")
    predict.add_argument("--img-width", type=int, default=int(_env("IMG_WIDTH", "320")), help="IMG_WIDTH")
    return top


def run(spark: SparkSession, args: argparse.Namespace):
    if args.job == "show-table":
        rows = read_jdbc(spark, JdbcConfig.from_env(), "derived")
        rows.printSchema()
        rows.show(args.rows)
        return rows
    if args.job == "cluster-table":
        cfg = KMeansConfig.from_env(k=args.k, max_iter=args.max_iter)
        split = {"fixed": KeyRange(), "none": None}.get(args.split, args.split)
        result = health_clustering.cluster_jdbc(spark, cfg=cfg, split=split, save_to=args.save_to)
        if args.probe:
            infer(probe_rows(spark), result.fitted).select("measure_name", "prediction").show(truncate=False)
        return result
    if args.job == "cluster-csv":
        cfg = KMeansConfig.unweighted(k=args.k)
        result = health_clustering.cluster_csv(spark, args.path or data_path(), cfg, args.infer_types, args.save_to, args.multiline)
        result.predictions.select("features", "prediction").show(5)
        centers = center_rows(result.fitted.model, spark)
        centers.show(centers.count(), truncate=False)
        print(f"Silhouette with squared Euclidean distance = {result.silhouette}")
        return result
    if args.job == "load-csv":
        if args.jdbc:
            return load_health.load_csv_to_jdbc(spark, args.path, None, args.batch_size, args.multiline)
        return load_health.load_csv_to_table(
            spark, args.path, args.table, args.database, args.location, args.multiline
        )
    if args.job == "train-csv":
        return supervised_training.train_classifier_from_csv(
            spark, args.data_path, args.output_dir, max_iter=args.max_iter, multiline=args.multiline
        )
    if args.job == "train":
        if args.data_is_images:
            return supervised_training.train_points_jointly_from_folder(
                spark, args.data_path, args.output_dir, args.img_height, args.img_width, epochs=args.epochs, batch_size=args.batch_size
            )
        cfg = TrainingConfig(batch_size=args.batch_size, epochs=args.epochs, learning_rate=args.learning_rate)
        return supervised_training.train_network_from_csv(spark, args.data_path, args.output_dir, cfg=cfg)
    if args.job == "predict-images":
        joint = f"{args.model_dir.rstrip('/')}/network"
        load = predictor(load_network(spark, joint)) if path_exists(spark, joint) else regressor_loader(load_regressor(args.model_dir))
        return predict_folder(spark, args.data_path, load, args.output, args.img_height, args.img_width)
    return supervised_training.train_points_from_folder(
        spark, args.data_path, args.output_dir, args.img_height, args.img_width
    )


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"orrery-{args.job}").getOrCreate()
    try:
        result = run(spark, args)
        if result is not None:
            print(result)
    finally:
        clear_scratch(spark)
        spark.stop()
