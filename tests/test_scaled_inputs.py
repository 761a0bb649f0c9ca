"""Work that must not gather in one task, one Python process or the driver."""

import numpy as np
from pyspark.sql import functions as F

from orrery.operators import networks as nets
from orrery.plans import derived_inputs
from orrery.registry import learning
from orrery.sources import image_files


def test_one_file_is_written_in_order_by_many_tasks(spark):
    rows = spark.range(5000).repartition(7).select((F.lit(9) * F.col("id")).alias("id"), F.concat(F.lit('a"b,\n'), "id").alias("t"))
    for order in ("id", None):
        path = derived_inputs.write_csv_file(rows, "one", order)
        assert image_files.list_files(spark, path).count() == 1
        read = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
        want = [f'a"b,\n{i}' for i in range(5000)]
        got = [r["t"] for r in read.collect()]
        assert got == want if order else sorted(got) == sorted(want)
        assert read.columns == (["t"] if order else ["id", "t"])


def test_a_task_works_on_slices_of_a_block(spark, monkeypatch):
    x = np.arange(50, dtype=float).reshape(25, 2)
    rows = spark.createDataFrame([(i, v.tolist(), float(i % 2)) for i, v in enumerate(x)], "id long, x array<double>, y double")
    blocks = nets.pack(rows, "id", "x", ["y"], 25)
    seen = lambda part, told: np.array([len(part), float(len(part) > 4), *part.sum(axis=0), told.sum()])
    monkeypatch.setattr(nets, "SLICE_ROWS", 4)
    out = nets.summed(blocks.table, 2, 1, seen, 5, 1)
    assert out.tolist() == [25, 0, *x.sum(axis=0), 12]
    monkeypatch.setattr(nets, "BLOCK_ROWS", 10)
    assert nets.pack(rows, "id", "x", ["y"], 25).table.count() == 3


def test_full_size_pictures_are_spread_by_their_number(spark, data, monkeypatch):
    monkeypatch.setattr(learning, "PICTURES_PER_TASK", 1)
    n = spark.read.parquet(f"{data}/embeddings.parquet").count()
    query = learning.image_features_full_size(spark, data)
    assert query.rdd.getNumPartitions() == max(n, spark.sparkContext.defaultParallelism)


def test_classifier_trains_on_every_core(spark, data, monkeypatch):
    from orrery.operators import supervised
    from orrery.plans.health_view import health_view

    parts = []
    found = supervised.spread
    monkeypatch.setattr(supervised, "spread", lambda df, n: parts.append(n) or found(df, n))
    monkeypatch.setattr(supervised, "TRAINING_ROWS", 10)
    trained = supervised.train_classifier(health_view(spark, data), "id", max_iter=2)
    assert parts == [max(-(-trained.training.count() // 10), spark.sparkContext.defaultParallelism)]


def test_files_are_looked_up_by_few_tasks(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"{i}.png").write_bytes(derived_inputs.png_bytes(bytes(12), 2, 2))
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    given, group = spark.conf.get(name), "few-lookups"
    spark.sparkContext.setJobGroup(group, group)
    try:
        pictures = image_files.read_pictures(spark, [f"{tmp_path}/{i}.png" for i in range(150)])
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        assert sum(tracker.getStageInfo(s).numTasks for s in stages) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert pictures.count() == 150 and spark.conf.get(name) == given
