"""Decoded images to model input, and predictions per image."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F, types as T

# Output rows per Arrow batch are chosen so that a batch stays near this size.
_BATCH_BYTES = 32 * 1024 * 1024


# Taps of one resize direction: source places and weights, each ``target x taps``.
Taps = tuple[np.ndarray, np.ndarray]


def _linear_taps(size: int, target: int) -> Taps:
    """Linear interpolation with half-pixel centres, no antialiasing."""
    place = (np.arange(target) + 0.5) * (size / target) - 0.5
    low = np.floor(place)
    share = place - low
    places = np.clip(np.stack([low, np.ceil(place)], axis=1), 0, size - 1).astype(np.intp)
    return places, np.stack([1 - share, share], axis=1).astype(np.float32)


def _cubic_taps(size: int, target: int) -> Taps:
    """Cubic convolution (a = -1/2), widened when shrinking; weights add up to one."""
    scale = size / target
    widen = max(scale, 1.0)
    center = (np.arange(target) + 0.5) * scale
    first = np.floor(center - 2 * widen).astype(np.intp)
    places = first[:, None] + np.arange(int(np.ceil(4 * widen)) + 2)[None, :]
    far = np.abs(places + 0.5 - center[:, None]) / widen
    near = (1.5 * far - 2.5) * far * far + 1
    tail = ((-0.5 * far + 2.5) * far - 4) * far + 2
    weights = np.where(far < 1, near, np.where(far < 2, tail, 0.0))
    weights[(places < 0) | (places >= size)] = 0.0
    return np.clip(places, 0, size - 1), weights / weights.sum(axis=1, keepdims=True)


def resize_taps(size: int, target: int, method: str = "bilinear", known: dict | None = None) -> Taps:
    """Taps of one direction; ``known`` keeps those of sizes met before."""
    known = {} if known is None else known
    key = (size, target, method)
    if key not in known:
        known[key] = {"bilinear": _linear_taps, "bicubic": _cubic_taps}[method](size, target)
    return known[key]


def _along_rows(picture: np.ndarray, taps: Taps) -> np.ndarray:
    places, weights = taps
    out = np.zeros((len(places), *picture.shape[1:]), weights.dtype)
    for k in range(places.shape[1]):
        out += picture[places[:, k]] * weights[:, k, None, None]
    return out


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Stored bytes (grey, BGR or BGRA) to ``height x width x 3`` in RGB order."""
    raw = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(raw, 3, axis=2) if channels == 1 else raw[:, :, 2::-1]


def resize(rgb: np.ndarray, height: int, width: int, method: str = "bilinear", known: dict | None = None) -> np.ndarray:
    """Resized picture: floats for ``bilinear`` (the training path), whole levels for
    ``bicubic`` (the inference path, which keeps 8-bit pictures after each direction).

    Each direction gathers the few source rows or columns that a target needs; a large
    picture stays in bytes until then.
    """
    rows, columns = resize_taps(rgb.shape[0], height, method, known), resize_taps(rgb.shape[1], width, method, known)
    turned = lambda picture: picture.transpose(1, 0, 2)
    if method == "bilinear":
        return turned(_along_rows(turned(_along_rows(rgb, rows)), columns))
    whole = lambda levels: np.clip(np.floor(levels + 0.5), 0, 255).astype(np.uint8)
    levels = rgb
    if width != rgb.shape[1]:
        levels = turned(whole(_along_rows(turned(levels), columns)))
    if height != rgb.shape[0]:
        levels = whole(_along_rows(levels, rows))
    return levels.astype(np.float32)


def scaled_pixels(data: bytes, size: tuple[int, int, int], target: tuple[int, int], method: str = "bilinear",
                  known: dict | None = None) -> np.ndarray:
    """Flat RGB floats in [0, 1]; ``size`` is height, width, channels."""
    resized = resize(to_rgb(data, *size), *target, method, known)
    return (resized / np.float32(255)).astype(np.float32, copy=False).reshape(-1)


def image_features(df: DataFrame, height: int, width: int, image: str = "image", keep: tuple[str, ...] = (),
                   method: str = "bilinear") -> DataFrame:
    """(``keep``, origin, height, width, pixels): RGB floats in [0, 1], row by row.

    Runs per Arrow batch on the executors. Spark hands over batches by row
    count, so results are emitted in slices of bounded size.
    """
    schema = T.StructType([
        *df.select(*keep).schema.fields, T.StructField("origin", T.StringType()),
        T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
        T.StructField("pixels", T.ArrayType(T.FloatType())),
    ])
    flat = df.select(*keep, *[F.col(f"{image}.{f}").alias(f"_{f}") for f in ("origin", "height", "width", "nChannels", "data")])
    slice_rows = max(1, _BATCH_BYTES // (height * width * 3 * 4))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for whole in batches:
            for start in range(0, whole.num_rows, slice_rows):
                part = whole.slice(start, slice_rows)
                inputs = [part.column(f"_{f}").to_pylist() for f in ("data", "height", "width", "nChannels")]
                pixels = [scaled_pixels(d, (h, w, c), (height, width), method, known) for d, h, w, c in zip(*inputs)]
                values = pa.array(np.concatenate(pixels), type=pa.float32())
                offsets = pa.array(np.arange(len(pixels) + 1, dtype=np.int32) * (height * width * 3))
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keep]
                    + [part.column("_origin"), pa.array([height] * n, pa.int32()), pa.array([width] * n, pa.int32()),
                       pa.ListArray.from_arrays(offsets, values)],
                    names=[*keep, "origin", "height", "width", "pixels"],
                )

    return flat.mapInArrow(convert, schema)


def image_predictions(
    df: DataFrame, load: Callable, height: int, width: int, image: str = "image", method: str = "bilinear",
    batch_size: int = 64,
) -> DataFrame:
    """(origin, x_px, y_px) of a two-output model over resized pictures.

    Resizing and prediction share one Python stage: stored bytes go in, two
    numbers come out, and the float pixels never leave the worker. ``load``
    returns a function of a ``batch x pixels`` array and runs once per worker.
    """

    def start() -> Callable:
        predict, known = load(), {}

        def run(data: np.ndarray, heights: np.ndarray, widths: np.ndarray, channels: np.ndarray) -> np.ndarray:
            pixels = [
                scaled_pixels(d, (int(h), int(w), int(c)), (height, width), method, known)
                for d, h, w, c in zip(data, heights, widths, channels)
            ]
            return predict(np.stack(pixels))

        return run

    udf = predict_batch_udf(start, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    parts = [F.col(f"{image}.{f}") for f in ("data", "height", "width", "nChannels")]
    scored = df.select(F.col(f"{image}.origin").alias("origin"), udf(*parts).alias("point"))
    return scored.select("origin", F.element_at("point", 1).alias("x_px"), F.element_at("point", 2).alias("y_px"))
