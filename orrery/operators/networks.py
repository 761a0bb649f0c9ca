"""Dense networks and joint linear models, trained in passes over packed batches.

Rows are laid out once: placed by the seeded permutation of their key, cut into batches of
``batch_size`` rows and packed to matrix blocks of a bounded size, a folder per batch. A step
reads the blocks of its batch only; each task hands back one vector of sums (loss, metric, rows,
gradients), wide or many vectors are added in two levels, and the driver applies the step.

Classifiers and regressors with hidden layers take Adam (or plain gradient) steps, several an
epoch. A linear model of any number of targets takes joint conjugate-gradient steps on the
normal equations instead: an epoch is one scan for all targets, which also yields the loss and
the errors of the weights it started with.

The driver holds the parameters; a lost executor costs its tasks and nothing else.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orrery.operators.metrics import PROBABILITY_EDGE
from orrery.operators.rows import SEED, batch, permute
from orrery.operators.supervised import HIDDEN_LAYERS, batch_predict
from orrery.runtime import scratch_path

#: Bytes of features in one block, and rows that it has at most.
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 1 << 17
#: Rows that a task works on at once: their activations and gradients of all layers are held together.
SLICE_ROWS = 1 << 13
#: Folders that one layout has at most; beyond that, several batches share one.
FOLDERS = 4096
#: Bytes of summed vectors that the driver takes from tasks at once; more are added in two levels.
DIRECT_BYTES = 64 << 20

# Constants of the Adam update.
_DECAY_1, _DECAY_2, _EPSILON = 0.9, 0.999, 1e-7


@dataclass(frozen=True)
class TrainingConfig:
    hidden: tuple[int, ...] = tuple(HIDDEN_LAYERS)
    batch_size: int = 1024
    epochs: int = 1
    learning_rate: float = 1e-3
    #: "adam" or "plain" (gradient steps).
    optimizer: str = "adam"
    standardize: bool = True
    seed: int = SEED


@dataclass
class Network:
    """Layers of (weights, bias), hidden ones with ReLU; inputs are shifted and scaled first."""

    layers: list[tuple[np.ndarray, np.ndarray]]
    shift: np.ndarray
    scale: np.ndarray
    classes: bool
    history: list[dict[str, float]] = field(default_factory=list)

    def outputs(self, x: np.ndarray) -> list[np.ndarray]:
        """Activations of all layers, the input first; the last one is linear."""
        a = [(x - self.shift) * self.scale]
        for i, (w, b) in enumerate(self.layers):
            z = a[-1] @ w + b
            a.append(np.maximum(z, 0) if i + 1 < len(self.layers) else z)
        return a

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self.outputs(np.asarray(x, np.float64))[-1]
        return softmax(z) if self.classes else z

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for layer in self.layers for v in layer])

    def with_flat(self, flat: np.ndarray) -> Network:
        layers, at = [], 0
        for w, b in self.layers:
            layers.append((flat[at : at + w.size].reshape(w.shape), flat[at + w.size : at + w.size + b.size]))
            at += w.size + b.size
        return Network(layers, self.shift, self.scale, self.classes, self.history)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def initial_network(sizes: Sequence[int], shift: np.ndarray, scale: np.ndarray, classes: bool, seed: int = SEED) -> Network:
    """Weights uniform within +-sqrt(6 / (in + out)), biases zero."""
    rng = np.random.default_rng(seed)
    layers = []
    for n, m in zip(sizes[:-1], sizes[1:]):
        reach = np.sqrt(6.0 / (n + m))
        layers.append((rng.uniform(-reach, reach, (n, m)), np.zeros(m)))
    return Network(layers, shift, scale, classes)


def batch_sums(net: Network, x: np.ndarray, y: np.ndarray, gradients: bool = True) -> np.ndarray:
    """[loss, metric, rows, gradients...], all summed over the rows.

    Classes: cross-entropy of clipped probabilities and hits; numbers: squared and absolute
    errors, each the mean over the targets.
    """
    a = net.outputs(x)
    n = len(x)
    if net.classes:
        p, label = softmax(a[-1]), y[:, 0].astype(np.int64)
        own = p[np.arange(n), label]
        loss = -np.log(np.clip(own, PROBABILITY_EDGE, 1 - PROBABILITY_EDGE)).sum()
        metric = float((p.argmax(axis=1) == label).sum())
        delta = p
        delta[np.arange(n), label] -= 1
    else:
        off = a[-1] - y
        loss, metric = (off * off).mean(axis=1).sum(), np.abs(off).mean(axis=1).sum()
        delta = 2 * off / y.shape[1]
    sums = [np.array([loss, metric, n], np.float64)]
    if gradients:
        grads = []
        for i in range(len(net.layers) - 1, -1, -1):
            grads += [delta.sum(axis=0), a[i].T @ delta]
            if i:
                delta = (delta @ net.layers[i][0].T) * (a[i] > 0)
        sums += [g.ravel() for g in reversed(grads)]
    return np.concatenate(sums)


# --- layout ---

@dataclass(frozen=True)
class Blocks:
    """Packed rows: (batch_id, folder, n, x, y) with float32 features and float64 targets."""

    table: DataFrame
    rows: int
    batches: int
    width: int
    targets: int
    #: Blocks of one batch, at most.
    per_batch: int

    def of(self, number: int) -> DataFrame:
        return self.table.filter((F.col("folder") == number // self._shared()) & (F.col("batch_id") == number))

    def _shared(self) -> int:
        return -(-self.batches // FOLDERS)


def _packed(width: int, targets: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        n = rows.num_rows
        x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
        y = rows["y"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if x.size != n * width or y.size != n * targets or not (np.isfinite(x).all() and np.isfinite(y).all()):
            raise ValueError(f"every row needs {width} finite features and {targets} finite targets")
        return pa.table({
            "batch_id": rows["batch_id"].slice(0, 1).cast(pa.int64()), "folder": rows["folder"].slice(0, 1).cast(pa.int64()), "n": pa.array([n], pa.int64()),
            "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary()),
        })

    return run


def pack(df: DataFrame, key: str, features: str, targets: Sequence[str], batch_size: int, seed: int = SEED) -> Blocks:
    """Lay out rows (an array column of features, numeric target columns) in seeded batches."""
    spark = df.sparkSession
    y = F.array(*[F.col(t).cast("double") for t in targets])
    rows = df.select(F.col(key).alias("_key"), F.col(features).cast("array<float>").alias("x"), y.alias("y"))
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = shape["n"], shape["width"]
    if not n:
        raise ValueError("no rows to train on")
    batches = -(-n // batch_size)
    block_rows = max(1, min(batch_size, BLOCK_ROWS, BLOCK_BYTES // (4 * max(1, width))))
    placed = batch(permute(rows, "_key", seed, "place"), batch_size, "place")
    block = F.floor((F.col("place") % batch_size) / block_rows)
    keyed = placed.withColumn("block", block).withColumn("folder", F.floor(F.col("batch_id") / F.lit(-(-batches // FOLDERS))))
    schema = "batch_id long, folder long, n long, x binary, y binary"
    path = scratch_path(spark, "blocks")
    keyed.groupBy("folder", "batch_id", "block").applyInArrow(_packed(width, len(targets)), schema).write.partitionBy("folder").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    return Blocks(table, n, batches, width, len(targets), -(-min(n, batch_size) // block_rows))


# --- sums over blocks ---

def _add_tables(group: pa.Table) -> pa.Table:
    group = group.sort_by("part")
    total = np.sum([np.asarray(v, np.float64) for v in group["sums"].to_pylist()], axis=0)
    return pa.table({"part": group["part"].slice(0, 1), "sums": pa.array([total], pa.list_(pa.float64()))})


def summed(blocks: DataFrame, width: int, targets: int, work: Callable, size: int, tasks: int) -> np.ndarray:
    """The sum of ``work(x, y)`` (vectors of ``size``) over all blocks; ``tasks`` bounds the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for x, y in zip(b["x"], b["y"]):
                rows = np.frombuffer(x.as_buffer(), np.float32).reshape(-1, width)
                told = np.frombuffer(y.as_buffer(), np.float64).reshape(-1, targets)
                for at in range(0, len(rows), SLICE_ROWS):
                    part = slice(at, at + SLICE_ROWS)
                    total += work(rows[part].astype(np.float64), told[part])
        part = pa.array([TaskContext.get().partitionId()], pa.int64())
        yield pa.RecordBatch.from_arrays([part, pa.array([total], pa.list_(pa.float64()))], names=["part", "sums"])

    schema = "part long, sums array<double>"
    parts = blocks.select("x", "y").mapInArrow(run, schema)
    if 8 * size * tasks > DIRECT_BYTES:
        fan = max(1, int(np.sqrt(tasks)))
        parts = parts.groupBy(F.pmod("part", F.lit(fan)).alias("g")).applyInArrow(_add_tables, schema)
    # Vectors are added in a fixed order, so a run gives the same weights again.
    told = sorted((r["part"], r["sums"]) for r in parts.collect())
    return np.sum([np.asarray(v) for _, v in told], axis=0) if told else np.zeros(size)


def _moments(blocks: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and standard deviation of the features, mean of the targets."""
    w, t = blocks.width, blocks.targets
    work = lambda x, y: np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), y.sum(axis=0)])
    total = summed(blocks.table, w, t, work, 2 * w + t, blocks.batches * blocks.per_batch) / blocks.rows
    mean, square = total[:w], total[w : 2 * w]
    return mean, np.sqrt(np.maximum(square - mean * mean, 0)), total[2 * w :]


def _scaling(blocks: Blocks, standardize: bool) -> tuple[np.ndarray, np.ndarray]:
    if not standardize:
        return np.zeros(blocks.width), np.ones(blocks.width)
    mean, deviation, _ = _moments(blocks)
    return mean, np.where(deviation > 1e-12 * (np.abs(mean) + 1e-300), 1 / np.where(deviation > 0, deviation, 1), 0.0)


def _shared(spark: SparkSession, value, run: Callable):
    """``run`` with a broadcast of ``value`` that is dropped afterwards."""
    held = spark.sparkContext.broadcast(value)
    try:
        return run(held)
    finally:
        held.destroy()


def _names(classes: bool) -> str:
    return "accuracy" if classes else "mae"


def _told(sums: np.ndarray, classes: bool, prefix: str = "") -> dict[str, float]:
    loss, metric, n = (float(v) for v in sums[:3])
    out = {f"{prefix}loss": loss / n, f"{prefix}{_names(classes)}": metric / n}
    if not classes:
        out[f"{prefix}mse"] = loss / n
    return out


def evaluate(net: Network, blocks: Blocks, prefix: str = "") -> dict[str, float]:
    """Loss and metrics of all rows, in one pass."""

    def run(held):
        work = lambda x, y: batch_sums(held.value, x, y, gradients=False)
        return summed(blocks.table, blocks.width, blocks.targets, work, 3, blocks.batches * blocks.per_batch)

    return _told(_shared(blocks.table.sparkSession, net, run), net.classes, prefix)


# --- training ---

def train_network(blocks: Blocks, outputs: int, classes: bool, cfg: TrainingConfig = TrainingConfig(),
                  validation: Blocks | None = None, start: Network | None = None) -> Network:
    """Adam or gradient steps, one a batch; batches come in a seeded order that differs by epoch.

    ``history`` has one entry an epoch: loss and metrics averaged over the rows as the steps met
    them, and those of ``validation`` at the end of the epoch.
    """
    spark = blocks.table.sparkSession
    if cfg.optimizer not in ("adam", "plain"):
        raise ValueError(f"unknown optimizer {cfg.optimizer}")
    net = start or initial_network([blocks.width, *cfg.hidden, outputs], *_scaling(blocks, cfg.standardize), classes, cfg.seed)
    flat = net.flat().copy()
    first, second, turn = np.zeros_like(flat), np.zeros_like(flat), 0
    history: list[dict[str, float]] = []
    for epoch in range(1, cfg.epochs + 1):
        totals = np.zeros(3)
        for number in np.random.default_rng([cfg.seed, epoch]).permutation(blocks.batches).tolist():
            def step(held, number=number):
                work = lambda x, y: batch_sums(held.value, x, y)
                return summed(blocks.of(number), blocks.width, blocks.targets, work, 3 + len(flat), blocks.per_batch)

            sums = _shared(spark, net.with_flat(flat), step)
            totals += sums[:3]
            gradient = sums[3:] / sums[2]
            if cfg.optimizer == "plain":
                flat = flat - cfg.learning_rate * gradient
                continue
            turn += 1
            first = _DECAY_1 * first + (1 - _DECAY_1) * gradient
            second = _DECAY_2 * second + (1 - _DECAY_2) * gradient * gradient
            rate = cfg.learning_rate * np.sqrt(1 - _DECAY_2**turn) / (1 - _DECAY_1**turn)
            flat = flat - rate * first / (np.sqrt(second) + _EPSILON)
        told = {"epoch": epoch, **_told(totals, classes)}
        if validation is not None:
            told |= evaluate(net.with_flat(flat), validation, "val_")
        history.append(told)
    trained = net.with_flat(flat)
    trained.history = history
    return trained


def train_linear(blocks: Blocks, epochs: int = 100, reg: float = 0.0, tolerance: float = 1e-10,
                 validation: Blocks | None = None) -> Network:
    """Least squares for all targets at once by conjugate gradients, one scan an epoch.

    ``reg`` weighs the squared weights of the standardised features against the mean squared
    error of half a target. An epoch's entry in ``history`` tells the errors of the weights it
    began with; training ends when no target's residual exceeds ``tolerance`` of its first one.
    """
    mean, deviation, centre = _moments(blocks)
    scale = np.where(deviation > 1e-12 * (np.abs(mean) + 1e-300), 1 / np.where(deviation > 0, deviation, 1), 0.0)
    d, t, n = blocks.width, blocks.targets, blocks.rows
    spark = blocks.table.sparkSession
    weights, direction = np.zeros((d, t)), np.zeros((d, t))
    residual = size = begun = None
    history: list[dict[str, float]] = []
    for epoch in range(1, epochs + 1):
        def scan(held):
            def work(x, y):
                w, p = held.value
                z = (x - mean) * scale
                off = z @ w - (y - centre)
                return np.concatenate([
                    [(off * off).mean(axis=1).sum(), np.abs(off).mean(axis=1).sum(), len(x)],
                    (z.T @ (off if residual is None else z @ p)).ravel(),
                ])

            return summed(blocks.table, d, t, work, 3 + d * t, blocks.batches * blocks.per_batch)

        sums = _shared(spark, (weights, direction), scan)
        told = {"epoch": epoch, **_told(sums, False)}
        if validation is not None:
            told |= evaluate(Network([(weights, centre)], mean, scale, False), validation, "val_")
        history.append(told)
        product = sums[3:].reshape(d, t) / n
        if residual is None:
            residual = -product
            direction, size = residual.copy(), (residual * residual).sum(axis=0)
            begun = size.copy()
        else:
            product = product + reg * direction
            bend = (direction * product).sum(axis=0)
            step = np.where(bend > 0, size / np.where(bend > 0, bend, 1), 0.0)
            weights = weights + step * direction
            residual = residual - step * product
            fresh = (residual * residual).sum(axis=0)
            direction = residual + np.where(size > 0, fresh / np.where(size > 0, size, 1), 0.0) * direction
            size = fresh
        if (size <= tolerance**2 * begun).all():
            break
    net = Network([(weights, centre)], mean, scale, False)
    net.history = history
    return net


# --- use ---

def predictor(net: Network) -> Callable:
    """The network as the loader that batch prediction takes."""
    return lambda: net.predict


def predict_column(features: Column, net: Network, batch_size: int = 1024) -> Column:
    """Probabilities of the classes, or the targets, as an array."""
    return batch_predict(features, predictor(net), net.layers[0][0].shape[0], batch_size)


def history_rows(spark: SparkSession, history: list[dict[str, float]]) -> DataFrame:
    """(epoch, metric, value)."""
    rows = [(int(h["epoch"]), k, float(v)) for h in history for k, v in h.items() if k != "epoch"]
    return spark.createDataFrame(rows, "epoch int, metric string, value double")


def save_network(spark: SparkSession, net: Network, path: str) -> None:
    """One row: sizes and history as JSON, numbers as little-endian doubles."""
    shape = json.dumps({"sizes": [list(w.shape) for w, _ in net.layers], "classes": net.classes, "history": net.history})
    numbers = np.concatenate([net.flat(), net.shift, net.scale]).astype("<f8").tobytes()
    spark.createDataFrame([(shape, bytearray(numbers))], "shape string, numbers binary").coalesce(1).write.mode("overwrite").parquet(path)


def load_network(spark: SparkSession, path: str) -> Network:
    row = spark.read.parquet(path).first()
    shape, numbers = json.loads(row["shape"]), np.frombuffer(bytes(row["numbers"]), "<f8")
    width = shape["sizes"][0][0]
    zero = [(np.zeros(s), np.zeros(s[1])) for s in shape["sizes"]]
    shift, scale = numbers[-2 * width : -width].copy(), numbers[-width:].copy()
    return Network(zero, shift, scale, shape["classes"], shape["history"]).with_flat(numbers[: -2 * width].copy())
