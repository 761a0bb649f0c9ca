"""Networks against finite differences, known steps and Spark's own least squares."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from orrery.operators import networks as nets
from orrery.operators.encode import feature_vector


def frame(spark, x, y, parts=4):
    rows = [(i, [float(v) for v in a], *[float(v) for v in b]) for i, (a, b) in enumerate(zip(x, y))]
    names = ", ".join(f"y{i} double" for i in range(len(y[0])))
    return spark.createDataFrame(rows, f"id long, x array<double>, {names}").repartition(parts)


@pytest.mark.parametrize("classes", [True, False])
def test_gradients_are_finite_differences(classes):
    rng = np.random.default_rng(0)
    net = nets.initial_network([3, 5, 4, 3 if classes else 2], rng.standard_normal(3), np.ones(3), classes, seed=4)
    net = net.with_flat(net.flat() + 0.1 * rng.standard_normal(len(net.flat())))
    x = rng.standard_normal((7, 3))
    y = rng.integers(0, 3, (7, 1)).astype(float) if classes else rng.standard_normal((7, 2))
    sums = nets.batch_sums(net, x, y)
    flat, step = net.flat(), 1e-6
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i] += step
        down[i] -= step
        slope = (nets.batch_sums(net.with_flat(up), x, y, False)[0] - nets.batch_sums(net.with_flat(down), x, y, False)[0]) / (2 * step)
        assert abs(slope - sums[3 + i]) < 1e-5 * max(1, abs(slope))


def test_blocks_hold_every_row_once(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.integers(-9, 9, (103, 4)), np.arange(103)[:, None]
    df = frame(spark, x, y).withColumnRenamed("x", "v").withColumn("batch_id", F.lit("z")).withColumn("_place", F.lit(0))
    for block_bytes, folders in ((8 << 20, 4096), (32, 3)):
        monkeypatch.setattr(nets, "BLOCK_BYTES", block_bytes)
        monkeypatch.setattr(nets, "FOLDERS", folders)
        blocks = nets.pack(df, "id", "v", ["y0"], 10)
        assert (blocks.rows, blocks.batches, blocks.width) == (103, 11, 4)
        got = {}
        for b in range(blocks.batches):
            part = blocks.of(b).collect()
            assert len(part) <= blocks.per_batch and sum(r["n"] for r in part) == (10 if b < 10 else 3)
            for r in part:
                got |= dict(zip(np.frombuffer(bytes(r["y"]), np.float64).tolist(), np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, 4).tolist()))
        assert got == {float(i): [float(v) for v in x[i]] for i in range(103)}
    with pytest.raises(ValueError):
        nets.pack(df.limit(0), "id", "v", ["y0"], 10)


def test_adam_against_a_plain_loop(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x, label = rng.standard_normal((60, 3)).astype(np.float32), rng.integers(0, 3, 60)
    blocks = nets.pack(frame(spark, x, label[:, None]), "id", "x", ["y0"], 16)
    cfg = nets.TrainingConfig(hidden=(5,), batch_size=16, epochs=3, learning_rate=0.01)
    net = nets.train_network(blocks, 3, True, cfg)
    monkeypatch.setattr(nets, "DIRECT_BYTES", 1)
    again = nets.train_network(blocks, 3, True, cfg)
    assert np.allclose(again.flat(), net.flat(), atol=1e-12)

    order = {}
    for b in range(blocks.batches):
        order[b] = [np.concatenate([np.frombuffer(bytes(r[c]), t).reshape(r["n"], -1) for r in blocks.of(b).collect()]) for c, t in (("x", np.float32), ("y", np.float64))]
    mean, dev = x.astype(float).mean(0), x.astype(float).std(0)
    plain = nets.initial_network([3, 5, 3], mean, 1 / dev, True)
    w = plain.flat()
    m, v, t = 0 * w, 0 * w, 0
    for epoch in range(1, 4):
        loss = 0.0
        for b in np.random.default_rng([cfg.seed, epoch]).permutation(blocks.batches):
            s = nets.batch_sums(plain.with_flat(w), order[b][0].astype(float), order[b][1])
            loss += s[0]
            g, t = s[3:] / s[2], t + 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7 / np.sqrt(1 - 0.999**t))
        assert abs(net.history[epoch - 1]["loss"] - loss / 60) < 1e-9
    assert np.allclose(net.flat(), w, atol=1e-9)


def test_a_separable_set_is_learned(spark, tmp_path):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 4, 800)
    x = np.array([[0, 0], [4, 0], [0, 4], [4, 4]])[label] + 0.5 * rng.standard_normal((800, 2))
    df = frame(spark, x, label[:, None])
    held = F.col("id") % 5 == 0
    blocks, validation = nets.pack(df.filter(~held), "id", "x", ["y0"], 64), nets.pack(df.filter(held), "id", "x", ["y0"], 1000)
    net = nets.train_network(blocks, 4, True, nets.TrainingConfig(epochs=6, batch_size=64, learning_rate=0.01), validation)
    assert [set(h) for h in net.history] == [{"epoch", "loss", "accuracy", "val_loss", "val_accuracy"}] * 6
    assert net.history[-1]["loss"] < net.history[0]["loss"] / 2 and net.history[-1]["val_accuracy"] > 0.95
    nets.save_network(spark, net, str(tmp_path / "net"))
    loaded = nets.load_network(spark, str(tmp_path / "net"))
    assert np.array_equal(loaded.flat(), net.flat()) and loaded.history == net.history
    scored = df.select("x", nets.predict_column(F.col("x"), loaded).alias("p")).collect()
    assert np.allclose([r["p"] for r in scored], net.predict(np.array([np.float32(r["x"]) for r in scored])), atol=1e-6)
    assert nets.history_rows(spark, net.history).count() == 24


def test_joint_least_squares_equal_two_separate_fits(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 6)).astype(np.float32) * [1, 10, 0.1, 3, 1, 0] + [0, 5, 1, -2, 9, 4]
    y = x @ rng.standard_normal((6, 2)) + [3, -1] + 0.3 * rng.standard_normal((300, 2))
    df = frame(spark, x, y)
    net = nets.train_linear(nets.pack(df, "id", "x", ["y0", "y1"], 1 << 30), epochs=30)
    assert len(net.history) <= 9
    vectors = feature_vector(df, "x")
    slopes = net.scale[:, None] * net.layers[0][0]
    for t in (0, 1):
        fit = LinearRegression(labelCol=f"y{t}", featuresCol="features").fit(vectors)
        assert np.allclose(slopes[:5, t], fit.coefficients.toArray()[:5], atol=1e-5)
        assert abs(net.layers[0][1][t] - net.shift @ slopes[:, t] - (fit.intercept + 4 * fit.coefficients[5])) < 1e-4
    off = net.predict(x) - y
    told = nets.evaluate(net, nets.pack(df, "id", "x", ["y0", "y1"], 50))
    assert abs(told["mse"] - (off**2).mean()) < 1e-5 and abs(told["mae"] - np.abs(off).mean()) < 1e-5
    losses = [h["loss"] for h in net.history]
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:])) and {"mae", "mse"} <= set(net.history[0])


def test_ridge_and_wrong_rows(spark):
    rng = np.random.default_rng(6)
    x, y = rng.standard_normal((80, 3)).astype(np.float32), rng.standard_normal((80, 2))
    df = frame(spark, x, y)
    net = nets.train_linear(nets.pack(df, "id", "x", ["y0", "y1"], 100), reg=0.5)
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z / 80 + 0.5 * np.eye(3), z.T @ (y - y.mean(0)) / 80)
    assert np.allclose(net.layers[0][0], want, atol=1e-5)
    with pytest.raises(Exception, match="finite features"):
        nets.pack(df.withColumn("y0", F.lit(None).cast("double")), "id", "x", ["y0"], 10)
    with pytest.raises(ValueError):
        nets.train_network(None or nets.pack(df, "id", "x", ["y0"], 100), 1, False, nets.TrainingConfig(optimizer="other"))


# --- jobs ---

def test_csv_to_network_and_back(spark, data, tmp_path):
    from orrery.plans import cli, derived_inputs
    from orrery.plans.health_view import health_view

    path = derived_inputs.write_csv(health_view(spark, data), "network-csv")
    out = str(tmp_path / "out")
    args = cli.parser().parse_args(["train", "--data-path", path, "--output-dir", out, "--epochs", "2", "--batch-size", "400"])
    report = cli.run(spark, args)
    assert {"loss", "accuracy", "val_loss", "val_accuracy"} <= set(report.metrics)
    stored = spark.read.json(report.history_path)
    assert sorted((r["epoch"], r["metric"]) for r in stored.collect()) == sorted((e, m) for e in (1, 2) for m in ("loss", "accuracy", "val_loss", "val_accuracy"))
    assert report.counts.rows == health_view(spark, data).count()
    net = nets.load_network(spark, report.model_path)
    assert [w.shape for w, _ in net.layers][:3] == [(3, 16), (16, 32), (32, 64)]


def test_pictures_to_joint_model_to_predictions(spark, data, tmp_path):
    import json

    from orrery.plans import cli, derived_inputs
    from orrery.sources import labels

    folder = derived_inputs.write_pictures(derived_inputs.pictures(spark, data).filter("vec_id < 40"))
    with open(f"{folder.removeprefix('file:')}/{labels.LABEL_FILE}", "w") as handle:
        for i in range(40):
            handle.write(json.dumps({"image": f"vec_{i}.png", "point": {"x_px": i * 1.0, "y_px": 60.0 - i}}) + "\n")
    out, size = str(tmp_path / "out"), ["--img-height", "4", "--img-width", "4"]
    report = cli.run(spark, cli.parser().parse_args(["train", "--data-is-images", "--data-path", folder, "--output-dir", out, "--epochs", "3", *size]))
    assert {"loss", "mae", "mse", "val_mae"} <= set(report.metrics)
    stored = spark.read.json(report.history_path).filter("metric = 'loss'").orderBy("epoch").collect()
    assert [r["epoch"] for r in stored] == [1, 2, 3, 4, 5] and stored[-1]["value"] < stored[0]["value"]
    args = ["predict-images", "--data-path", folder, "--model-dir", out, "--output", str(tmp_path / "p"), *size]
    assert cli.run(spark, cli.parser().parse_args(args)).count() == 40
